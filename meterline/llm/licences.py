"""Licence scan by canonical digests.

Texts are brought to a canonical form (case, copyright statements, punctuation, equivalent spellings) and hashed;
the digest of the entire text, also without a title line before it, is joined with the digests of known licence texts.
The same is done for the parts of a document that can be a licence text of their own, its paragraphs and lines, so a
notice inside a document is found as well. Short known texts stand here as texts, long ones as digests of their
canonical form; ``digests_of_files`` adds a folder of licence files. Everything is built-in DataFrame functions;
the known table, a few dozen rows, is the only thing broadcast.

Null and empty texts have an empty canonical form, which no licence has. Repeated rows each give a row, whatever
their id, null included. Very long texts are hashed whole. Where licences share a digest the first name counts. Extra
columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Known licence texts and the usual notices, as their stewards publish them, without copyright lines.
KNOWN = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.\n\nYou should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# the same conditions as a list with bullets
KNOWN += [(name, re.sub(r"(?m)^[0-9]\. ", "* ", text)) for name, text in KNOWN if "\n1. " in text]

# Digests of the canonical form of full licence texts as published, with and without what follows their terms.
FULL = [
    ("Apache-2.0", "426233c169d8482d53cf478fef5dbb53"),
    ("Apache-2.0", "a6a73e499aa50f6258349b2d20eaa734"),
    ("Artistic-1.0-Perl", "e30ac97ebebab03877601d1542c62f86"),
    ("BSD-3-Clause", "ab0ca1a09d1a808f5eb6a8c0f53429ec"),
    ("CC0-1.0", "1d015b476c495ce9fd3c17ca84d87272"),
    ("GFDL-1.2", "1b5144b4a100302770e3d0cd25cc31e6"),
    ("GFDL-1.3", "ab77ca70c4f09a4aeb795daf4164986c"),
    ("GPL-1.0", "ceab22d798f0d678b263130d27540b51"),
    ("GPL-1.0", "f64a75f20d09c96d86a08e3e0112c5e5"),
    ("GPL-2.0", "9874f07466be7be821eea9a35e4c705c"),
    ("GPL-2.0", "ef95a6221bc9b5a7be73f34eec09e03f"),
    ("GPL-3.0", "8d23c8971d674493fa7263f0915588fc"),
    ("GPL-3.0", "970a2eb3903d3be9141dc8dda19acda6"),
    ("LGPL-2.0", "0873d219b381fba6155d5497a2ca0c0b"),
    ("LGPL-2.0", "ec381bca0da7aed1819a177676628f28"),
    ("LGPL-2.1", "031d25e5b011c0e57c2256f599e77e86"),
    ("LGPL-2.1", "693a0601c3340149a7fc32bfa1373c71"),
    ("LGPL-3.0", "a9038743e2c31fecb7a400534950c7d2"),
    ("MPL-1.1", "370443a8be400961420b9b1b74533603"),
    ("MPL-2.0", "50a3e516cc4851e5830abb96023e3d9c"),
]

# Title lines that may stand before a known text, in canonical form.
TITLES = ["mit", "mit license", "the mit license", "mit license mit", "the mit license mit", "expat license", "isc license", "the isc license",
          "isc license isc", "the isc license isc", "bsd license", "the bsd license", "bsd 2 clause license", "the bsd 2 clause license",
          "bsd 2 clause simplified license", "simplified bsd license", "bsd 3 clause license", "the bsd 3 clause license",
          "bsd 3 clause new or revised license", "modified bsd license", "new bsd license", "zlib license", "the zlib license",
          "bsd zero clause license", "zero clause bsd", "0bsd"]

# Words after "copyright" that do not name a holder.
TERMS = ["notice", "notices", "holder", "holders", "owner", "owners", "law", "laws", "license", "licenses", "licence", "licences", "and", "or",
         "in", "on", "of", "for", "to", "is", "are", "as", "that", "interest", "interests", "statement", "statements", "protection", "act",
         "treaty", "treaties", "disclaimer", "disclaimers", "permission", "claims", "rights", "status", "the software", "the program",
         "the work", "the library"]

# Rewriting steps of the canonical form, in the order they apply. Upper-case A-Z is lowered before.
STEPS = [
    (r"(?md)^[^a-z0-9\n]*(copyright[^a-z0-9\n]+(?!(" + "|".join(TERMS) + r")([^a-z0-9]|$))[a-z0-9]|(copyright[^a-z0-9\n]*)?©|"
     r"\(c\)[^a-z\n]*[0-9]{4})[^\n]*$", ""),  # copyright statements, line by line
    (r"(?md)^[^a-z0-9\n]*all[^a-z0-9\n]+rights[^a-z0-9\n]+reserved[^a-z0-9\n]*$", ""),
    (r"[^\p{L}\p{N}\n]+", " "),  # punctuation and blanks
    (r"is(e|ed|es|er|ers|ing|ation|ations)([ \n]|$)", r"iz\1\2"),  # authorise, authorize
    (r"our(s|ed|ing|able|ite)?([ \n]|$)", r"or\1\2"),  # favour, favor
    (r"licenc", "licens"),
    (r"(^|[ \n])(sub|non) (licens|infring|commercial)", r"\1\2\3"),
    (r"https([ \n]|$)", r"http\1"),
    (r" ?\n ?", "\n"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """The canonical form with its line breaks."""
    out = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    for pattern, to in STEPS:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(to.replace("\\", "$")))
    return out


def flat(form: Column) -> Column:
    return F.trim(F.regexp_replace(form, F.lit(r"[ \n]+"), F.lit(" ")))


def untitled(form: Column) -> Column:
    """The form without a known title line at its beginning, if anything follows it."""
    return F.regexp_replace(form, F.lit(r"^[ \n]*(" + "|".join(TITLES) + r") ?\n[ \n]*([^ \n])"), F.lit("$2"))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """digest, license of the given texts, or of all known ones; a digest of several licences takes the first by name."""
    rows = spark.createDataFrame(KNOWN if known is None else known, "license string, text string")
    rows = rows.select("license", F.md5(flat(canonical(F.col("text")))).alias("digest"))
    if known is None:
        rows = rows.unionByName(spark.createDataFrame(FULL, "license string, digest string"))
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


def digests_of_files(spark: SparkSession, folder: str) -> DataFrame:
    """digest, license of a folder of licence texts, each named by its file; terms also count without what follows them."""
    texts = spark.read.text(folder, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("license"), "value")
    ends = F.regexp_replace("value", F.lit(r"(?s)(END OF TERMS AND CONDITIONS).*"), F.lit("$1"))
    return (texts.select("license", F.explode(F.array_distinct(F.array("value", ends))).alias("text"))
            .select("license", F.md5(flat(canonical(F.col("text")))).alias("digest"))
            .groupBy("digest").agg(F.min("license").alias("license")))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """For every document (doc_id, text): digest of the entire text, the licence it is, licences of its parts."""
    form = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), canonical(F.col("text")).alias("form"))
    parts = F.array_distinct(F.concat(F.split("form", "\n\n+"), F.split("form", "\n+")))
    digests = form.select("doc_id", "row", F.md5(flat(F.col("form"))).alias("text_digest"),
                          F.md5(flat(untitled(F.col("form")))).alias("body_digest"),
                          F.transform(parts, lambda p: F.md5(flat(p))).alias("parts"))
    units = digests.select("doc_id", "row", "text_digest", "body_digest", F.explode(F.array_distinct(
        F.concat(F.array("text_digest", "body_digest"), "parts"))).alias("digest"))
    joined = units.join(F.broadcast(known), "digest", "left")
    whole = F.when(F.col("digest").isin(F.col("text_digest"), F.col("body_digest")), F.col("license"))
    return (joined.groupBy("row", "doc_id", "text_digest")
            .agg(F.max(whole).alias("whole_license"), F.collect_set("license").alias("found"))
            .select("doc_id", "text_digest", "whole_license", F.array_join(F.array_sort("found"), ",").alias("licenses")))


def scan_sql() -> str:
    """The scan line by line and word by word, without the rewriting steps above."""
    start = "^[^a-z0-9]*"

    def matches(pattern: str) -> str:
        return f"regexp_matches(l, {_quoted(pattern)})"
    statement = " OR ".join([
        f"({matches(start + 'copyright[^a-z0-9]+[a-z0-9]')} AND NOT {matches(start + 'copyright[^a-z0-9]+(' + '|'.join(TERMS) + ')([^a-z0-9]|$)')})",
        matches(start + "(copyright[^a-z0-9]*)?©"), matches(start + r"\(c\)[^a-z]*[0-9]{4}"), matches(start + "all[^a-z0-9]+rights[^a-z0-9]+reserved[^a-z0-9]*$")])
    word = "w"
    for pattern, to in (("is(e|ed|es|er|ers|ing|ation|ations)$", r"iz\1"), ("our(s|ed|ing|able|ite)?$", r"or\1"), ("https$", "http")):
        word = f"regexp_replace({word}, {_quoted(pattern)}, {_quoted(to)})"
    words = f"list_transform(regexp_extract_all(l, {_quoted(chr(92) + 'p{L}[' + chr(92) + 'p{L}' + chr(92) + 'p{N}]*|' + chr(92) + 'p{N}[' + chr(92) + 'p{L}' + chr(92) + 'p{N}]*')}), lambda w: replace({word}, 'licenc', 'licens'))"
    line = f"regexp_replace(array_to_string({words}, ' '), '(^| )(sub|non) (licens|infring|commercial)', '\\1\\2\\3', 'g')"

    def form(text: str) -> str:
        lines = f"string_split(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), chr(10))"
        return f"array_to_string(list_transform({lines}, lambda l: CASE WHEN {statement} THEN '' ELSE {line} END), chr(10))"

    def flattened(text: str) -> str:
        return f"trim(regexp_replace({text}, {_quoted('[ \n]+')}, ' ', 'g'))"
    body = f"regexp_replace(form, {_quoted('^[ \n]*(' + '|'.join(TITLES) + ')\n[ \n]*([^ \n])')}, '\\2')"
    values = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN)
    full = ", ".join(f"({_quoted(name)}, {_quoted(digest)})" for name, digest in FULL)
    return f"""
WITH k AS (SELECT digest, min(license) AS license FROM (
  SELECT license, md5({flattened(form('text'))}) AS digest FROM (VALUES {values}) v(license, text)
  UNION ALL SELECT license, digest FROM (VALUES {full}) v(license, digest)) GROUP BY 1),
f AS (SELECT doc_id, row_number() OVER () AS row, {form('text')} AS form FROM documents),
d AS (SELECT doc_id, row, md5({flattened('form')}) AS text_digest, md5({flattened(body)}) AS body_digest,
  list_concat(string_split_regex(form, {_quoted('\n\n+')}), string_split_regex(form, {_quoted('\n+')})) AS parts FROM f),
u AS (SELECT doc_id, row, text_digest, body_digest, unnest(list_distinct(list_concat(
  list_transform(parts, lambda p: md5({flattened('p')})), [text_digest, body_digest]))) AS digest FROM d)
SELECT doc_id, text_digest, max(CASE WHEN digest IN (text_digest, body_digest) THEN license END) AS whole_license,
  coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses
FROM u LEFT JOIN k USING (digest) GROUP BY doc_id, row, text_digest"""


def _quoted(text: str) -> str:
    """An SQL string."""
    return "'" + text.replace("'", "''") + "'"
