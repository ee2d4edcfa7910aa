"""Licences, packing, mixing and scoring on small tables, each against a plain computation."""

import math
import os
import pathlib
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterline.llm import backoff_lm, licences, mixing, packing, quality, repeats
from meterline.llm.q_text import RANKS
from meterline.llm.textbytes import Words, shingles, text_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# licences

def test_licence_scan(spark, docs):
    mit = dict(licences.KNOWN[:1])["MIT"]
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,")), (2, "prose\nReleased under the MIT Licence!\nmore"),
            (3, None), (4, ""), (5, "plain"), (5, "plain"), (6, "Licenced under CC BY-NC 4.0\nSPDX-License-Identifier: ISC")]
    found = {(r["doc_id"], r["whole_license"], r["licenses"])
             for r in licences.scan(docs(rows, clash=True), licences.known_digests(spark)).collect()}
    assert found == {(1, "MIT", "MIT"), (2, None, "MIT"), (3, None, ""), (4, None, ""), (5, None, ""), (6, None, "CC-BY-NC-4.0,ISC")}
    assert licences.scan(docs(rows), licences.known_digests(spark)).count() == 7
    assert licences.scan(docs([]), licences.known_digests(spark)).count() == 0


ISC_FILE = """ISC License

Copyright (c) 2021, Someone <someone@example.org>

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
PUBLISHED = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0",
             "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0",
             "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}


def test_whole_licences_by_spark_and_by_words(spark, docs, tmp_path):
    """Full texts, titles, usual wrapping and holders' lines; the SQL goes line by line and word by word."""
    known = dict(reversed(licences.KNOWN))
    mit, bsd = licences.KNOWN[0][1], next(t for n, t in licences.KNOWN if n == "BSD-3-Clause")
    two = next(t for n, t in licences.KNOWN if n == "BSD-2-Clause")
    texts = {"MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + mit: "MIT", "The MIT License (MIT)\nCopyright The Authors\n" + mit: "MIT",
             ISC_FILE: "ISC", ISC_FILE.replace("\n", "\r\n"): "ISC", ISC_FILE.replace("(c) 2021, ", "© "): "ISC",
             "BSD 3-Clause License\n\nCopyright 2019, X. All rights reserved.\n\n" + "\n".join(textwrap.wrap(bsd, 40)): "BSD-3-Clause",
             "BSD 2-Clause \"Simplified\" License\n" + two.replace("1. ", " * ").replace("2. ", " * "): "BSD-2-Clause",
             "MIT License": "MIT", "MIT License\n\nprose of another kind": None, "": None, "copyright notice\nnon commercial licence\nsub-licence": None,
             "(c) You must retain\n(c) 1999 Someone\n© nobody\nhttps our colours realise\n\nMIT License\n": None}
    folder = pathlib.Path("/usr/share/common-licenses")
    for name, licence in PUBLISHED.items():
        if (folder / name).exists():
            text = (folder / name).read_text()
            texts[text] = licence
            texts[text.upper().replace(" ", "  ")] = licence
            texts[text.partition("END OF TERMS AND CONDITIONS")[0] + ("END OF TERMS AND CONDITIONS" if "END OF TERMS AND" in text else "")] = licence
    assert known["MIT"] == mit
    rows = list(enumerate(texts)) + [(None, None), (None, "Copyright notices and more"), (0, "word " * 200_000)]
    found = [tuple(x) for x in licences.scan(docs(rows), licences.known_digests(spark)).collect()]
    assert {k: w for k, _, w, _ in found if k} == {k: w for k, w in enumerate(texts.values()) if k}
    pq.write_table(pa.table({"doc_id": pa.array([k for k, _ in rows], pa.int64()), "text": [t for _, t in rows]}), tmp_path / "d.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d.parquet'")
    assert sorted(map(str, db.execute(licences.scan_sql()).fetchall())) == sorted(map(str, found))


def test_digests_of_a_folder(spark, docs, tmp_path):
    (tmp_path / "House-1").write_text("Copyright 2020 Us\nUse it well.\nEND OF TERMS AND CONDITIONS\nHow to apply")
    known = licences.digests_of_files(spark, str(tmp_path))
    texts = ["use IT well\nend of terms and conditions", "Use it well. End of terms and conditions. How to apply", "Use it"]
    found = {x["doc_id"]: x["whole_license"] for x in licences.scan(docs(list(enumerate(texts))), known).collect()}
    assert found == {0: "House-1", 1: "House-1", 2: None}


# packing

def test_cut_of_long_texts():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def test_ids_are_those_of_the_tokenizer(prose):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    mine = packing.encoder(RANKS)
    for text in [prose(50, 1), "Überall ñandú — 12,5 €\n\n\tx  y", "", "<|endoftext|> a", "aaaa" * 300, "漢字 🙂"]:
        assert mine.encode_ordinary(text) == reference.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_matched_as_the_contract_says(docs):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext |>", "é<|ENDOFTEXT|>", "plain", ""]
    out = packing.token_pieces(docs(list(enumerate(texts))).select("doc_id", "text"), RANKS, 1024, 2).collect()
    for r in out:
        ids = [*reference.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 2]
        assert (r["length"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert len(out) == len(texts)


def test_packing_round_trip(docs, prose):
    rows = [(k, prose(3 + 7 * (k % 40), k)) for k in range(150)] + [(150, None), (151, ""), (7, prose(52, 7)), (152, prose(900, 9))]
    length = 128
    out = packing.pack(docs(rows, clash=True), RANKS, length=length, end_id=2).collect()
    encode = packing.encoder(RANKS).encode_ordinary
    wanted = Counter()
    for doc, text in rows:
        ids = [*encode(text or ""), 2]
        for k, (s, n) in enumerate(packing.cut(len(ids), length)):
            wanted[doc, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == wanted
    by = defaultdict(list)
    for r in out:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    sizes = [r["length"] for r in out]
    assert len(by) <= len(packing.best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, length)) + 1
    assert packing.pack(docs([]), RANKS).count() == 0


def test_crossover_keeps_every_piece():
    import random
    rng = random.Random(3)
    sizes = [rng.randint(1, 90) for _ in range(400)]
    one = packing.best_fit(list(range(400)), sizes, 100)
    two = packing.best_fit(sorted(range(400), key=lambda i: -sizes[i]), sizes, 100)
    child = packing.crossover(one, two, sizes, 100, rng)
    assert sorted(i for _, b in child for i in b) == list(range(400))
    assert all(load == sum(sizes[i] for i in b) <= 100 for load, b in child)
    best = packing.evolve([one, two], sizes, 100, 30, rng)
    assert len(best) <= len(two)


# mixing

def test_every_source_stays_within_a_block_of_its_target(spark, docs):
    rows = [(k, "", s) for s, n in (("a", 640), ("b", 320), ("c", 90), (None, 40), ("", 15)) for k in range(n)]
    out = mixing.interleave(docs(rows, clash=True), block=4).collect()
    assert len(out) == len(rows) and Counter(r["source"] for r in out) == Counter(r[2] for r in rows)
    assert len({(r["source"], r["doc_id"]) for r in out}) == len(rows)
    blocks = Counter((r["slot"], r["source"], r["block"]) for r in out)
    assert len({slot for slot, _, _ in blocks}) == len(blocks) and max(blocks.values()) == 4
    counts = spark.createDataFrame([("n" if s is None else "s" + s, n) for s, n in Counter(r[2] for r in rows).items()], "key string, n long")
    parts = {r["key"]: (r["share"], r["period"]) for r in mixing.shares(counts, F.sqrt("n")).collect()}
    plan = mixing.schedule(mixing.shares(counts, F.sqrt("n"))).orderBy("slot").collect()
    done = Counter()
    for t, r in enumerate(plan):
        assert r["slot"] == t
        done[r["key"]] += 1
        assert all(abs(done[k] - (t + 1) * s / p) < 1 for k, (s, p) in parts.items())
    assert mixing.interleave(docs([])).count() == 0


def test_repeated_and_null_ids_are_placed(docs):
    rows = [(1, "", "a"), (1, "", "a"), (None, "", "a"), (None, "", None)]
    out = mixing.interleave(docs(rows)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["1", "1", "None", "None"]


# scoring

def test_scores_are_those_of_the_model(docs, prose):
    common = "the cat sat on the mat and the dog sat on the rug today"
    rows = [(k, f"{common} {prose(6, k)}" if k % 3 else prose(20, k)) for k in range(80)] + [(80, None), (81, ""), (5, "The CAT"), (90, "\n")]
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    out = backoff_lm.score(docs(rows, clash=True), ~held, orders=3).collect()
    train = [lowered(t or "") for k, t in rows if zlib.crc32(str(k).encode()) % 10]
    tokens = lambda t: [*WORD.findall(lowered(t or "")), "\0end"]
    grams = [Counter() for _ in range(4)]
    for t in train:
        w = tokens(t)
        for n in (1, 2, 3):
            grams[n].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    total, kinds = sum(grams[1].values()), len(grams[1])
    kept = [None, *({g: c for g, c in grams[n].items() if c >= 2} for n in (1, 2, 3))]

    def p(word, context):
        if not context:
            return (grams[1][word,] + 0.1) / (total + 0.1 * (kinds + 1))
        mine = {g[-1]: c for g, c in kept[len(context) + 1].items() if g[:-1] == context}
        if word in mine:
            return (mine[word] - 0.5) / grams[len(context)][context]
        if not mine:
            return p(word, context[1:])
        left = 1 - sum((c - 0.5) / grams[len(context)][context] for c in mine.values())
        return left / (1 - sum(p(w, context[1:]) for w in mine)) * p(word, context[1:])
    wanted = Counter()
    for k, t in rows:
        w = tokens(t)
        base = sum(math.log10(p(x, ())) for x in w)
        full = sum(math.log10(p(x, tuple(w[max(0, i - 2):i]))) for i, x in enumerate(w))
        wanted[k, len(w), sum(grams[1][x,] > 0 for x in w), total, round(base, 6), round(full, 6)] += 1
    got = Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in out)
    assert got == wanted
    assert backoff_lm.score(docs([]), F.lit(True)).count() == 0
    assert [r["score"] for r in backoff_lm.score(docs([(1, "a b")]), F.lit(False)).collect()] == [0.0]


def test_rare_grams_count_at_every_size(docs, monkeypatch):
    # what occurs twice is kept however many tokens there are, in one portion or many
    filler = [(k, "x " * 100_000) for k in range(2, 120)]
    pair = [(0, "red fox runs"), (1, "red fox runs"), (1000, "red fox runs"), (1001, "fox red runs")]
    monkeypatch.setattr(backoff_lm, "PORTION", 1 << 19)
    monkeypatch.setattr(backoff_lm, "RANGE", 1 << 20)
    found = {r["doc_id"]: r for r in backoff_lm.score(docs(pair + filler), F.col("doc_id") < 1000).collect()}
    assert found[0]["score"] > found[0]["base_score"] + 10
    assert abs(found[1000]["score"] - found[0]["score"]) < 1e-9 and found[1001]["score"] < found[0]["score"] - 5


# quality

def test_quality_on_held_out_rows(spark, docs, prose):
    noisy = lambda k: " | ".join(prose(12, k).split()) if k % 2 else " ".join(w for w in prose(8, k).split() for _ in range(6))
    rows = [(k, noisy(k) if k % 4 == 0 or k % 8 == 1 else prose(25, k) + ".") for k in range(300)] + [(300, None), (301, ""), (0, noisy(0))]
    labels = spark.createDataFrame([(k, int(not (k % 4 == 0 or k % 8 == 1))) for k in range(300)] + [(300, None)], "doc_id long, quality int")
    frame = docs(rows, clash=True)
    out = quality.score(frame, quality.fitted(frame, labels), "q").withColumn("held", quality.held_out("doc_id", 5)).collect()
    assert len(out) == len(rows) and all(0 <= r["q"] <= 1 for r in out)
    held = [r for r in out if r["held"] and r["doc_id"] < 300]
    assert sum((r["q"] >= 0.5) == (not (r["doc_id"] % 4 == 0 or r["doc_id"] % 8 == 1)) for r in held) >= 0.95 * len(held)
    empty = quality.fitted(frame, labels.where("false"))
    assert {r["q"] for r in quality.score(frame, empty, "q").collect()} == {0.5}
    assert quality.score(docs([]), quality.fitted(docs([]), labels)).count() == 0


def test_quality_that_shows_in_words_only(spark, docs, monkeypatch):
    """Texts of one form (lower-case words, a full stop): only their vocabulary tells them apart."""
    bad, good = "buy cheap pills cash win prize now spam bonus click".split(), "rain over the old town kept the market quiet today".split()
    r = random.Random(4)
    rows = [(k, " ".join(r.choice(bad if k % 2 else good) for _ in range(30)) + ".") for k in range(200)]
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(200)], "doc_id long, quality int")
    model = quality.fitted(docs(rows), labels)
    out = {x["doc_id"]: x["score"] for x in quality.score(docs(rows + [(None, rows[1][1])]), model).collect()}
    assert all((out[k] >= 0.5) == (k % 2 == 0) for k in range(200)) and out[None] < 0.3
    # ids of many rows: the voters stay bounded
    many = quality.fit(docs(rows * 3), labels, "quality", voters=50)
    assert len(many.labels) == 50


def test_scores_ignore_other_columns(docs, spark, prose):
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    rows = [(k, prose(10, k) + (" | | |" if k % 2 else "")) for k in range(40)]
    model = quality.fitted(docs(rows), labels)
    a = [r["score"] for r in quality.score(docs([(1, "one | | | two", "s")]), model).collect()]
    b = [r["score"] for r in quality.score(docs([(2, "one | | | two", None)]), model).collect()]
    assert a == b


# repeats

def plain_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), runs, bytes(b for b, g in zip(r, gone) if not g)))
    return out


@pytest.mark.parametrize("split", [repeats.SPLIT, 300])
def test_repeats_against_plain_search(docs, prose, split, monkeypatch):
    monkeypatch.setattr(repeats, "LONGEST", 40)
    shared = prose(30, 99)
    texts = [prose(20, 1) + shared + prose(20, 2), prose(5, 3) + shared + shared, "ab" * 300, "c" * 500, None, "", shared[:39], shared[:40],
             prose(40, 4), prose(40, 4), "é" * 60 + shared, *(f"{prose(3, k)} {shared[:90]} {prose(3, k + 50)}" for k in range(100, 130))]
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[8])]
    out = repeats.cut_texts(docs(rows, clash=True), length=40, split=split).collect()
    wanted = Counter((k, *w) for (k, _), w in zip(rows, plain_repeats([t for _, t in rows], 40)))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_bytes"])) for r in out) == wanted
    assert repeats.cut_texts(docs([])).count() == 0


@pytest.mark.parametrize("lane", [1, 7, 512])
def test_suffix_array_and_common_prefixes(lane, prose, monkeypatch):
    monkeypatch.setattr(repeats, "LANE", lane)
    shared = prose(12, 9).encode()
    for raw in (b"", b"a", b"a" * 70, b"x\0\0", b"\0" * 20, b"ab" * 40 + b"\0a", shared + prose(9, 1).encode() + shared + shared, bytes(range(256)) * 2):
        order, place, words = repeats.suffix_array(np.frombuffer(raw, np.uint8))
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        assert place[order].tolist() == list(range(len(raw)))
        for most in (5, 40, 1000):
            found = repeats.common_prefixes(order, words, most).tolist()
            for a, b in zip(order.tolist(), order[1:].tolist()):
                assert found[b] == min(most, len(os.path.commonprefix([raw[a:], raw[b:]])))


def test_long_texts_in_parts(docs, prose, monkeypatch):
    monkeypatch.setattr(repeats, "PORTION", 500)
    shared = prose(60, 5)
    texts = [prose(400, 1) + shared + prose(300, 2), shared + prose(50, 3)]
    out = repeats.cut_texts(docs(list(enumerate(texts))), length=50).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_bytes"])) for r in out] == plain_repeats(texts, 50)


def test_texts_left_are_valid(docs):
    text = "ü" * 150
    out = repeats.without_repeats(docs([(1, "é" + text), (2, text + "x"), (3, None)], clash=True)).orderBy("doc_id").collect()
    assert [r["text"] for r in out] == ["é", "x", None]


# words

def test_words_and_shingles():
    import pyarrow as pa
    texts = ["A b\tc d E f a b c d e", "", None, "one", "x y", "  lead\n", "É é ü"]
    data, offsets = text_bytes(pa.array(texts))
    words = Words(data, offsets)
    assert [int(n) for n in np.diff(words.first)] == [len(WORD.findall(t or "")) for t in texts]
    value, row = shingles(words)
    for k, t in enumerate(texts):
        w = WORD.findall(lowered(t or ""))
        plain = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        assert (row == k).sum() == len(plain)


def test_long_texts_are_walked_in_stretches(monkeypatch):
    r = np.random.default_rng(5)
    first = np.array([0, 1, 40, 41, 300])
    root, pair = -r.random(300), np.where(r.random(300) < 0.5, np.nan, -r.random(300))
    of = r.integers(0, 6, 300)  # 5 is no context
    fail = np.append(-r.random(5), 0.0)
    wanted = []
    for a, b in zip(first, first[1:]):
        state, total = 5, 0.0
        for t in range(a, b):
            total += fail[state] + root[t] if np.isnan(pair[t]) else pair[t]
            state = of[t]
        wanted.append(total)
    for stretch in (1, 7, 1024):
        monkeypatch.setattr(backoff_lm, "STRETCH", stretch)
        assert np.allclose(backoff_lm.walk(first, [root, pair], [fail], [of]), wanted)


def test_a_shard_of_near_copies_takes_few_bytes_a_byte():
    import tracemalloc

    import pyarrow as pa
    r = np.random.default_rng(1)
    base, texts = r.integers(97, 105, 300).astype(np.uint8), []
    for _ in range(3000):
        texts.append(base.copy())
        texts[-1][r.integers(0, 300, 6)] = 97 + r.integers(0, 8)
    batch = pa.table({"hash": np.zeros(3000, np.int64), "digest": np.arange(3000), "shard": np.full(3000, -1, np.int32),
                      "n": np.ones(3000, np.int32), "bytes": pa.array([t.tobytes() for t in texts], pa.binary())}).to_batches()[0]
    tracemalloc.start()
    found = list(repeats._shard_ranges(200)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(f.num_rows for f in found) > 100 and peak < 85 * 900_000


def test_texts_are_cut_in_one_python_step(spark, docs, prose):
    shared = prose(80, 1)
    rows = [(1, prose(20, 2) + " é" + shared), (2, shared + "é" + prose(20, 3)), (3, None)]
    cut = repeats.without_repeats(docs(rows))
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    left = {r["doc_id"]: r["text"] for r in cut.collect()}
    bytes_left = {r["doc_id"]: bytes(r["kept_bytes"]) for r in repeats.cut_texts(docs(rows)).collect()}
    assert left == {1: bytes_left[1].decode(errors="ignore"), 2: bytes_left[2].decode(errors="ignore"), 3: None}
    assert len(left[1]) < len(rows[0][1]) - len(shared) + 2


def test_many_small_hashes_take_little_memory_at_once():
    import tracemalloc

    r = np.random.default_rng(2)
    texts = [r.integers(97, 105, 460).astype(np.uint8) for _ in range(2000)]
    texts = [t for t in texts for _ in range(4)]  # 3.7 MB in groups of 1.8 kB
    n = len(texts)
    batch = pa.table({"hash": np.arange(n) // 4, "digest": np.arange(n), "shard": np.full(n, -1, np.int32),
                      "n": np.ones(n, np.int32), "bytes": pa.array([t.tobytes() for t in texts], pa.binary())}).to_batches()[0]
    tracemalloc.start()
    found = list(repeats._shard_ranges(200)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(f.num_rows for f in found) == n and peak < 90 << 20


def test_voters_are_weighted_with_little_beside_their_vectors():
    import tracemalloc

    r, n = np.random.default_rng(3), 2048
    at = [np.sort(r.choice(quality.TERMS, 400, replace=False)) for _ in range(n)]
    value = [r.random(400).astype(np.float32) for _ in range(n)]
    value[7][:] = 0
    idf = (1 + r.random(quality.TERMS)).astype(np.float32)
    sample = [{"at": a.astype(np.uint16).tobytes(), "value": v.tobytes()} for a, v in zip(at, value)]
    tracemalloc.start()
    x = quality._weighted(sample, idf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = np.zeros((n, quality.TERMS), np.float32)
    for k in range(n):
        whole[k, at[k]] = value[k]
    assert (x == quality._unit(whole * idf)).all() and peak < 2 * x.nbytes
    assert quality._weighted([], idf).shape == (0, quality.TERMS)
