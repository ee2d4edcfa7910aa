"""Importance resampling towards a target distribution, with hashed n-gram features.

Words are runs of digits, letters and characters beyond ASCII, A-Z lowered; the features of a text are all runs of
one to three consecutive words, joined by one space. A feature's bucket is the CRC-32 of its bytes modulo the number
of buckets. CRC-32 is linear: the value of a span is the XOR of one contribution per byte, which depends only on the
byte and its distance from the span's end, and of a constant for the length. So a table of distance by byte is built
once, the contributions of all spans are looked up together and folded by ``bitwise_xor.reduceat``. A span longer
than the table is cut into blocks from its end, which are folded pairwise, each left one moved by the length of the
right one.

Every bucket gets a gain from its counts in target and corpus; a text's weight is the sum of its features' gains, its
score that weight with Gumbel noise drawn from the id. The highest scores are drawn, numbered over a range layout, so
that no task holds more than its share. Counts leave a task as at most one row per bucket; only the gains, one number
per bucket, pass through the driver.

Null and empty texts have no features: weight 0. They are numbered only if texts without words count as eligible. A
null id draws its noise as an empty text and goes before other ids in a tie. Rows that repeat an id count, score and
are drawn each by itself. Very long texts and words are cut into blocks, so memory stays a small multiple of the text.
Extra columns are not looked at. An empty corpus gives no rows; an empty target gives every bucket its plain gain.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import stored
from meterline.llm.textbytes import chunks, text_bytes
from meterline.operators.ordered import numbered

DEPTH = 64  # bytes of a block: rows of the position table
CHUNK = 1 << 16  # bytes of text handled at once
GATHER = 1 << 19  # contributions looked up at once
RUN = 3  # words of the longest feature

_CLEAN = np.full(256, 0x20, np.uint8)  # the byte as a word holds it; 0x20 for bytes of no word
_CLEAN[0x30:0x3A] = np.arange(0x30, 0x3A)
_CLEAN[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLEAN[0x41:0x5B] = np.arange(0x61, 0x7B)
_CLEAN[0x80:] = np.arange(0x80, 0x100)


def _byte_steps() -> np.ndarray:
    """CRC-32 of every byte value from state zero, by the reflected polynomial."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = (state >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (state & np.uint32(1)))
    return state


class PositionTable:
    """Contributions of bytes by distance from the end, moves of a state over whole blocks, and length constants."""

    def __init__(self, depth: int = DEPTH):
        step = _byte_steps()
        rows = [step]
        for _ in range(depth - 1):
            rows.append((rows[-1] >> np.uint32(8)) ^ step[rows[-1] & np.uint32(255)])
        self.depth = depth
        self.flat = np.concatenate(rows)
        # moving a state over ``depth`` zero bytes: one row of 256 for each byte of the state
        ones = np.arange(256, dtype=np.uint32)
        move = []
        for byte in range(4):
            state = ones << np.uint32(8 * byte)
            for _ in range(depth):
                state = (state >> np.uint32(8)) ^ step[state & np.uint32(255)]
            move.append(state)
        self._moves = [np.array(move)]
        self._constants = np.array([zlib.crc32(bytes(n)) for n in range(4 * depth)], np.uint32)

    @staticmethod
    def _apply(move: np.ndarray, state: np.ndarray) -> np.ndarray:
        return (move[0][state & np.uint32(255)] ^ move[1][(state >> np.uint32(8)) & np.uint32(255)]
                ^ move[2][(state >> np.uint32(16)) & np.uint32(255)] ^ move[3][state >> np.uint32(24)])

    def moved(self, state: np.ndarray, level: int) -> np.ndarray:
        """The state after depth * 2**level more zero bytes."""
        while len(self._moves) <= level:
            last = self._moves[-1]
            self._moves.append(np.array([self._apply(last, row) for row in last]))
        return self._apply(self._moves[level], state)

    def constants(self, length: np.ndarray) -> np.ndarray:
        if not len(length) or length.max() < len(self._constants):
            return self._constants[length]
        sizes, which = np.unique(length, return_inverse=True)
        return np.array([zlib.crc32(bytes(n)) for n in sizes.tolist()], np.uint32)[which]

    def _blocks(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """XOR of the contributions of blocks no longer than the table."""
        out = np.empty(len(begin), np.uint32)
        upto = np.cumsum(end - begin)
        at = 0
        while at < len(begin):
            base = int(upto[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(upto, base + GATHER, "right")))
            size = end[at:to] - begin[at:to]
            last = upto[at:to] - base
            step = np.arange(int(last[-1]))
            place = step + np.repeat(end[at:to] - last, size)
            distance = np.repeat(last, size) - 1 - step
            values = self.flat[(distance << 8) | data[place]]
            out[at:to] = np.bitwise_xor.reduceat(values, last - size)
            at = to
        return out

    def crcs(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """CRC-32 of the non-empty spans [begin, end) of the bytes."""
        length = end - begin
        if not len(length):
            return np.zeros(0, np.uint32)
        if length.max() <= self.depth:
            return self._blocks(data, begin, end) ^ self.constants(length)
        pieces = -(-length // self.depth)
        span = np.repeat(np.arange(len(length)), pieces)
        nth = np.arange(len(span)) - np.repeat(np.cumsum(pieces) - pieces, pieces)  # counted from the span's end
        till = end[span] - nth * self.depth
        value = self._blocks(data, np.maximum(begin[span], till - self.depth), till)
        level = 0
        while len(value) > len(length):
            left = (nth & 1) == 1
            value[left] = self.moved(value[left], level)
            heads = np.flatnonzero(~left)
            value = np.bitwise_xor.reduceat(value, heads)
            nth = nth[heads] >> 1
            level += 1
        return value ^ self.constants(length)


def features(column: pa.Array, table: PositionTable, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """By chunks of rows: the first row, the words of each row, and row and bucket of every feature, row by row in runs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    none, line = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    data, offsets = text_bytes(pc.binary_join_element_wise(column, none, line))  # every text ends with a line
    for a, b in chunks(offsets, CHUNK):
        raw = _CLEAN[data[offsets[a]:offsets[b]]]
        word = raw != 0x20
        keep = word.copy()
        keep[1:] |= word[:-1]  # one blank behind each word
        clean = raw[keep]
        ends = np.flatnonzero(clean == 0x20)
        starts = np.empty_like(ends)
        starts[:1] = 0
        starts[1:] = ends[:-1] + 1
        kept = np.concatenate([[0], np.cumsum(keep)])[offsets[a:b + 1] - offsets[a]]
        first = np.searchsorted(starts, kept)
        words = np.diff(first)
        row = np.repeat(np.arange(b - a), words)
        room = np.repeat(first[1:], words) - np.arange(len(starts))
        tops = [np.flatnonzero(room >= n) for n in range(1, RUN + 1)]
        at = np.concatenate(tops)
        till = np.concatenate([ends[t + n] for n, t in enumerate(tops)])
        crc = table.crcs(clean, starts[at], till)
        yield a, words, row[at], (crc % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = 10000) -> DataFrame:
    """bucket, n: features of all texts by bucket, buckets without any left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = PositionTable(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, bucket in features(batch.column(0), table, buckets):
                total += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])
    return (texts.select(column).mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = 10000) -> np.ndarray:
    """The gain of every bucket: thousandths of the log ratio of its smoothed shares in target and corpus."""
    both = (corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
            .groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")))
    seen = both.toPandas()  # a row per bucket at most
    s, t = np.zeros(buckets), np.zeros(buckets)
    s[seen["bucket"]], t[seen["bucket"]] = seen["s"], seen["t"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PositionTable()
        for batch in batches:
            words, count, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for a, per_row, row, bucket in features(batch.column(1), table, len(gain)):
                b = a + len(per_row)
                words[a:b] = per_row
                count[a:b] = np.bincount(row, minlength=b - a)
                weight[a:b] = np.rint(np.bincount(row, weights=gain[bucket], minlength=b - a)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in (words, count, weight))],
                                             names=["doc_id", "n_words", "n_features", "weight"])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = 42) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
             buckets: int = 10000) -> DataFrame:
    """doc_id, n_features, weight, score, rank: rank numbers the drawn documents by score, the others have none.

    ``target`` has a column ``text``. Of the documents with ``least_words`` words, floor(percent / 100) are drawn.
    """
    gain = gains(bucket_counts(docs, "text", buckets), bucket_counts(target, "text", buckets), buckets)
    weighed = weigh(docs, gain)
    scored = stored(weighed.select("doc_id", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"),
                                   (F.col("n_words") >= least_words).alias("eligible")), "scored")
    drawn = scored.where("eligible").count() * percent // 100
    placed = numbered(scored, ["eligible"], [F.desc("score"), "doc_id", "n_features", "weight"], "place")
    rank = F.when(F.col("eligible") & (F.col("place") <= drawn), F.col("place").cast("long"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def drawn_documents(docs: DataFrame, ranks: DataFrame) -> DataFrame:
    """The documents whose ids were drawn, with all their columns."""
    return docs.join(ranks.where("rank IS NOT NULL").select("doc_id").distinct(), "doc_id", "left_semi")


SQL = r"""
WITH RECURSIVE steps(b, v, k) AS (
  SELECT b::UBIGINT, b::UBIGINT, 0 FROM range(256) r(b)
  UNION ALL SELECT b, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
step AS (SELECT b, v FROM steps WHERE k = 8),
texts AS (SELECT 0 AS part, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark),
rows AS (SELECT part, id, row_number() OVER () AS rid, regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS (SELECT part, rid, unnest(list_concat(w, list_concat(
  list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
  list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f FROM rows),
counted AS (SELECT part, rid, f, count(*) AS n FROM grams GROUP BY ALL),
names AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM counted)),
longest AS (SELECT max(length(x)) // 2 AS n FROM names),
contribution(d, b, v) AS (
  SELECT 0, b, v FROM step
  UNION ALL SELECT d + 1, c.b, xor(c.v >> 8, s.v) FROM contribution c JOIN step s ON s.b = c.v % 256 WHERE d + 1 < (SELECT n FROM longest)),
zeros(n, v) AS (
  SELECT 0, 4294967295::UBIGINT
  UNION ALL SELECT n + 1, xor(z.v >> 8, s.v) FROM zeros z JOIN step s ON s.b = z.v % 256 WHERE n < (SELECT n FROM longest)),
bytes AS (SELECT f, length(x) // 2 - i AS d, ('0x' || substr(x, 2 * i - 1, 2))::UBIGINT AS b
  FROM (SELECT f, x, unnest(range(1, length(x) // 2 + 1)) AS i FROM names)),
linear AS (SELECT f, bit_xor(v) AS v FROM bytes JOIN contribution USING (d, b) GROUP BY f),
bucket AS (SELECT l.f, xor(xor(l.v, z.v), 4294967295::UBIGINT) % 10000 AS bucket
  FROM linear l JOIN names USING (f) JOIN zeros z ON z.n = length(x) // 2),
tally AS (SELECT bucket, sum(CASE WHEN part = 0 THEN n ELSE 0 END)::DOUBLE AS s, sum(CASE WHEN part = 1 THEN n ELSE 0 END)::DOUBLE AS t
  FROM counted JOIN bucket USING (f) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS g FROM tally),
weights AS (SELECT rid, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM counted JOIN bucket USING (f) JOIN gain USING (bucket)
  WHERE part = 0 GROUP BY rid),
scored AS (SELECT r.id AS doc_id, len(w) >= 20 AS eligible, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(r.id::VARCHAR, '')), 1, 8))::UBIGINT::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
  FROM rows r LEFT JOIN weights USING (rid) WHERE part = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS place,
  count(*) FILTER (WHERE eligible) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= n * 5 // 100 THEN place END AS rank FROM placed"""
