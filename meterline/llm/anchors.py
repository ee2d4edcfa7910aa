"""Removal of repeated word sequences by fixed-block anchors.

A window is ``length`` consecutive words of one document; it is repeated if the same words also start earlier: in a
document with a smaller id, or earlier in the same one. Every window holds a whole block of ``length // 2`` words
that begins at a multiple of that size in its document. So these non-overlapping reference blocks are the index, and
every rolling run of block size is a probe: a run is an anchor if it equals an indexed block and occurs at least twice.
A window without an anchor is not repeated. Anchors are extended to both sides to all windows that hold them; per
sequence the earliest start is found, every other one is repeated, and runs of repeated windows are the maximal exact
repeats that go.

Documents are dealt to portions of bounded text by a hash of id and text. A portion sends each distinct hash once,
packed by hash range, so a passage in a third of all documents arrives once per portion; each range answers every
portion with its anchors. Likewise a portion sends only its own earliest start of a window and is told whether that is
repeated too; its later ones it knows itself. Index and probes are compared in 32 bits within a range, which can only
add anchors; windows are compared by two independent 64-bit digests.

Null and empty texts have no words. A null id counts as smaller than any other. Rows that share an id are texts of one
document: a window in two of them at one start is not earlier in either, so rows that repeat id and text come out
alike. Such rows share a portion. A very long text is one portion's alone, in memory of about fifty times its size in
words. Extra columns are kept by ``cut_texts``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.packs import as_table, cuts, dealt, packed_planes, packed_rising, steps, unpacked_bits, unpacked_planes, unpacked_rising
from meterline.llm.storage import forget, free, release, stored
from meterline.llm.textbytes import U, Words, chunks, mix, runs, text_bytes

PORTION = 8 << 20  # bytes of text per portion
RANGE = 48 << 20  # bytes of text whose hashes one range compares
_EXACT = [mix(np.arange(256, dtype=np.uint64) + U(seed)) for seed in (0x51ED2701, 0x2545F491)]  # what a byte counts in a word's two hashes
_NO_ID = np.iinfo(np.int64).min


class Portion:
    """The words of a portion's texts with their hashes and places."""

    def __init__(self, texts: pa.ChunkedArray, digests: int):
        data, offsets = text_bytes(texts)
        hashes, counts = [[np.zeros(0, np.uint64)] for _ in range(digests)], [np.zeros(0, np.int64)]
        for a, b in chunks(offsets):
            part = data[offsets[a]:offsets[b]]
            words = Words(part, offsets[a:b + 1] - offsets[a], _EXACT[0])
            counts.append(np.diff(words.first))
            hashes[0].append(words.hash)
            for k in range(1, digests):
                hashes[k].append(words.hashed(part, _EXACT[k]))
        self.hashes = [np.concatenate(h) for h in hashes]
        self.counts = np.concatenate(counts)
        self.first = np.cumsum(self.counts) - self.counts
        self.place = np.arange(int(self.counts.sum())) - np.repeat(self.first, self.counts)
        self.room = np.repeat(self.counts, self.counts) - self.place

    def row(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, words, "right") - 1

    def probes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Words at which a run of block size starts, of texts that have a window, and the hashes of these runs."""
        size = length // 2
        at = np.flatnonzero((self.room >= size) & (self.place + self.room >= length))
        return at, runs(self.hashes[0], size)[at]


_SENT = "part int, portion int, n int, hashes binary, often binary, indexed binary"


def _send_runs(length: int, ranges: int):
    """A portion's distinct runs by range: whether each occurs again in it and whether it is a reference block."""
    def send(rows: pa.Table) -> pa.Table:
        portion = Portion(rows.column("text"), 1)
        at, hashes = portion.probes(length)
        order = np.argsort(hashes)
        hashes, block = hashes[order], portion.place[at[order]] % (length // 2) == 0
        heads = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]) != 0) if len(hashes) else np.zeros(0, np.int64)
        size = np.diff(heads, append=len(hashes))
        indexed = np.logical_or.reduceat(block, heads) if len(heads) else block
        part, local = dealt(hashes[heads], ranges)
        pieces = cuts(part)
        return as_table(_SENT, part=[int(part[a]) for a, _ in pieces], portion=[rows.column("portion")[0].as_py()] * len(pieces),
                      n=[b - a for a, b in pieces], hashes=[packed_rising(local[a:b]) for a, b in pieces],
                      often=[np.packbits(size[a:b] > 1).tobytes() for a, b in pieces],
                      indexed=[np.packbits(indexed[a:b]).tobytes() for a, b in pieces])
    return send


_ANCHORS = "portion int, part int, anchors binary"


def _find_anchors(rows: pa.Table) -> pa.Table:
    """What each portion of a range's runs has of its anchors."""
    n = rows.column("n").to_numpy()
    each = [unpacked_rising(p, k) for p, k in zip(rows.column("hashes").to_pylist(), n.tolist())]
    often, indexed = (np.concatenate([unpacked_bits(p, k) for p, k in zip(rows.column(c).to_pylist(), n.tolist())]) for c in ("often", "indexed"))
    hashes = np.concatenate(each)
    values, which = np.unique(hashes, return_inverse=True)
    seen = np.bincount(which, weights=1.0 + often, minlength=len(values))
    block = np.bincount(which, weights=indexed, minlength=len(values))
    anchor = ((seen > 1) & (block > 0))[which]
    ends = np.cumsum(n)
    found = [h[anchor[e - k:e]].astype("<u4") for h, e, k in zip(each, ends.tolist(), n.tolist())]
    some = [i for i, f in enumerate(found) if len(f)]
    return as_table(_ANCHORS, portion=rows.column("portion").take(some).to_pylist(), part=rows.column("part").take(some).to_pylist(),
                  anchors=[found[i].tobytes() for i in some])


# "sent": digests, id, start and row of the portion's earliest start of each window; "known": row and start of repeated
# windows; "rows": ids and text hashes of the portion's rows, by which the two name them
_WINDOWS = "part int, portion int, kind int, n int, body binary"
_SEND, _KNOWN, _ROWS = 0, 1, 2
_SENT_WINDOW = np.dtype([("a", "u8"), ("b", "u8"), ("id", "i8"), ("start", "i4"), ("row", "i4")])
_PLACE = np.dtype([("row", "i4"), ("start", "i4")])
_ROW = np.dtype([("id", "i8"), ("null", "i4"), ("hash", "i8")])


def _packed(w: np.ndarray) -> bytes:
    """Windows in the order of their first digest, or places in any order."""
    if "a" in w.dtype.names:
        return packed_planes([steps(w["a"]), *(w[c] for c in ("b", "id", "start", "row"))])
    w = w[np.lexsort((w["start"], w["row"]))]
    return packed_planes([w["row"], w["start"]])


def _unpacked(packed: bytes, n: int, dtype: np.dtype) -> np.ndarray:
    out = np.zeros(n, dtype)
    for name, column in zip(dtype.names, unpacked_planes(packed, n, [dtype[c].str[1:] for c in dtype.names])):
        out[name] = np.cumsum(column, dtype=np.uint64) if name == "a" else column
    return out


def _earliest(w: np.ndarray) -> np.ndarray:
    """Whether each window has the earliest start of its sequence; ``w`` is in the order of digests, id and start."""
    new = np.ones(len(w), bool)
    new[1:] = (w["a"][1:] != w["a"][:-1]) | (w["b"][1:] != w["b"][:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(w)), 0))
    return (w["id"] == w["id"][head]) & (w["start"] == w["start"][head])


def _ordered(w: np.ndarray) -> np.ndarray:
    return w[np.lexsort((w["start"], w["id"], w["b"], w["a"]))]


def _extend_anchors(length: int, ranges: int):
    """The windows of a portion that hold an anchor: its earliest of each sequence to send, the others known."""
    def extend(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows or not answers.num_rows:
            return as_table(_WINDOWS, part=[], portion=[], kind=[], n=[], body=[])
        portion = Portion(rows.column("text"), 2)
        name = rows.column("portion")[0].as_py()
        ids = rows.column("doc_id").combine_chunks()
        missing = np.asarray(ids.is_null())
        ids = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        anchors = np.sort(np.concatenate([(U(p) << U(32)) | np.frombuffer(body, "<u4").astype(np.uint64)
                                          for p, body in zip(answers.column("part").to_pylist(), answers.column("anchors").to_pylist())]))
        at, hashes = portion.probes(length)
        part, local = dealt(hashes, ranges)
        code = (part.astype(np.uint64) << U(32)) | local
        near = np.searchsorted(anchors, code)
        hit = at[anchors[np.minimum(near, len(anchors) - 1)] == code]
        held = np.zeros(len(portion.place) + length + 1, np.int64)
        held[hit + 1] = 1
        held = np.cumsum(held)  # anchors before each word
        start = np.flatnonzero(portion.room >= length)
        start = start[held[start + length - length // 2 + 1] > held[start]]
        w = np.zeros(len(start), _SENT_WINDOW)
        w["a"], w["b"] = (runs(h, length)[start] for h in portion.hashes)
        w["row"] = portion.row(start)
        w["id"], w["start"] = ids[w["row"]], portion.place[start]
        w = _ordered(w)
        first = _earliest(w)
        sent, known = w[first], w[~first]
        part, _ = dealt(sent["a"], ranges)
        pieces = cuts(part)
        own = np.zeros(rows.num_rows, _ROW)
        own["id"], own["null"], own["hash"] = ids, missing, rows.column("text_hash").to_numpy()
        return as_table(_WINDOWS, part=[*(int(part[a]) for a, _ in pieces), name % ranges, name % ranges], portion=[name] * (len(pieces) + 2),
                      kind=[_SEND] * len(pieces) + [_KNOWN, _ROWS], n=[*(b - a for a, b in pieces), len(known), len(own)],
                      body=[*(_packed(sent[a:b]) for a, b in pieces), _packed(known[["row", "start"]]), own.tobytes()])
    return extend


_ANSWER = "portion int, kind int, n int, body binary"


def _answer_windows(rows: pa.Table) -> pa.Table:
    """Which of the portions' earliest starts are repeats of another portion's; everything else passes."""
    given = {c: rows.column(c).to_pylist() for c in ("portion", "kind", "n", "body")}
    portion, n, body = given["portion"], given["n"], given["body"]
    sent = [i for i, k in enumerate(given["kind"]) if k == _SEND]
    out = {c: [v for v, k in zip(values, given["kind"]) if k != _SEND] for c, values in given.items()}
    if sent:
        each = [_unpacked(body[i], n[i], _SENT_WINDOW) for i in sent]
        w, home = np.concatenate(each), np.repeat([portion[i] for i in sent], [len(e) for e in each])
        order = np.lexsort((w["start"], w["id"], w["b"], w["a"]))
        late = order[~_earliest(w[order])]
        late = late[np.argsort(home[late], kind="stable")]
        for a, b in cuts(home[late]):
            out["portion"].append(int(home[late[a]]))
            out["kind"].append(_KNOWN)
            out["n"].append(b - a)
            out["body"].append(_packed(w[["row", "start"]][late[a:b]]))
    return as_table(_ANSWER, **out)


_SPANS = "doc_id long, text_hash long, spans array<struct<b:int,e:int>>"


def _spans(length: int):
    """The words covered by repeated windows, as spans of each text of a portion."""
    def join(rows: pa.Table) -> pa.Table:
        given = list(zip(*(rows.column(c).to_pylist() for c in ("kind", "n", "body"))))
        own = np.frombuffer(b"".join(body for kind, _, body in given if kind == _ROWS), _ROW)
        at = np.concatenate([_unpacked(body, n, _PLACE) for kind, n, body in given if kind == _KNOWN])
        at = at[np.lexsort((at["start"], at["row"]))]
        new = np.ones(len(at), bool)
        new[1:] = (at["row"][1:] != at["row"][:-1]) | (at["start"][1:] > at["start"][:-1] + length)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(at)) - 1 if len(heads) else heads
        row, begin, end = at["row"][heads], at["start"][heads], at["start"][tails] + length
        pieces = cuts(row)
        mine = own[[int(row[a]) for a, _ in pieces]] if pieces else own[:0]
        places = pa.array([0, *(b for _, b in pieces)], pa.int32())
        spans = pa.ListArray.from_arrays(places, pa.StructArray.from_arrays([pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))], names=["b", "e"]))
        return pa.table([pa.array(mine["id"].astype(np.int64), mask=mine["null"] != 0), pa.array(mine["hash"].astype(np.int64)), spans],
                        names=["doc_id", "text_hash", "spans"])
    return join


def repeated_spans(docs: DataFrame, length: int = 20) -> DataFrame:
    """doc_id, text_hash, spans: words [b, e) covered by repeated windows, of the texts that have any.

    Texts in ``docs`` are told apart by doc_id, an integer, and the xxhash64 of the text.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    portions, ranges = 1 + size // PORTION, 1 + size // RANGE
    portioned = (docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
             .withColumn("portion", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(portions)).cast("int")))
    portioned = portioned.repartition("portion").dropDuplicates(["portion", "doc_id", "text_hash"])
    anchors = stored(portioned.select("portion", "text").groupBy("portion").applyInArrow(_send_runs(length, ranges), _SENT)
                     .groupBy("part").applyInArrow(_find_anchors, _ANCHORS), "anchors")
    release(docs.sparkSession)
    windows = portioned.groupBy("portion").cogroup(anchors.groupBy("portion")).applyInArrow(_extend_anchors(length, ranges), _WINDOWS)
    out = stored(windows.groupBy("part").applyInArrow(_answer_windows, _ANSWER)
                 .groupBy("portion").applyInArrow(_spans(length), _SPANS), "repeated-spans")
    forget(anchors)
    release(docs.sparkSession)
    return out


CUT = ("kept_text", "n_words", "n_removed", "n_spans")


def cut_texts(docs: DataFrame, length: int = 20, added: tuple[str, ...] = CUT) -> DataFrame:
    """The documents with the words that are left, joined by one space, the words, those removed and the removed runs.

    ``added`` names the new columns; an input column of such a name is replaced.
    """
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added))
    names = docs.columns
    id_, hash_, found_ = (free(c, names) for c in ("span_id", "span_hash", "spans"))
    spans = repeated_spans(docs, length).select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("spans").alias(found_))
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_)), "left")
    fields = [T.StructField(c, T.StringType() if k == 0 else T.LongType()) for k, c in enumerate(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(names.index("text")))
            found = batch.column(len(names))
            for a, b in chunks(offsets):
                yield _cut(batch.slice(a, b - a), data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], found.slice(a, b - a), names, added)
    return joined.select(*(F.col(f"`{c}`") for c in names), found_).mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def _cut(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, found: pa.Array, names: list[str], added: tuple[str, ...]) -> pa.RecordBatch:
    words = Words(data, offsets)
    gone = np.zeros(len(words.start) + 1, np.int64)
    lists, flat = found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), found.flatten()
    first = np.repeat(words.first[:-1], lists)
    np.add.at(gone, first + flat.field("b").to_numpy(zero_copy_only=False), 1)
    np.add.at(gone, first + flat.field("e").to_numpy(zero_copy_only=False), -1)
    keep = np.cumsum(gone)[:-1] == 0
    # the bytes of the kept words, each followed by one blank but for the last of its row
    size = (words.end - words.start)[keep] + 1
    ends = np.cumsum(size)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(words.start[keep] - (ends - size), size)
    out = data[np.minimum(place, len(data) - 1)]
    out[ends - 1] = 0x20
    kept = np.bincount(words.row[keep], minlength=words.rows)
    last = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(kept)])]
    raw = out.tobytes()
    texts = [raw[a:max(a, b - 1)].decode() for a, b in zip(last[:-1].tolist(), last[1:].tolist())]
    n = np.diff(words.first)
    return pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(texts, pa.string()), pa.array(n), pa.array(n - kept),
                                       pa.array(lists.astype(np.int64))], names=[*names, *added])


SQL = r"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT row, doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM t),
s AS (SELECT row, doc_id, i, word,
  CASE WHEN count(*) OVER x = 20 THEN md5(string_agg(word, ' ') OVER x) END AS k
  FROM p WINDOW x AS (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
r AS (SELECT row, i, word,
  k IS NOT NULL AND row_number() OVER () > 0 AND min((doc_id, i)) OVER (PARTITION BY k) < (doc_id, i) AS repeated FROM s),
c AS (SELECT row, i, word, bool_or(repeated) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r),
k AS (SELECT row, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k USING (row)"""
