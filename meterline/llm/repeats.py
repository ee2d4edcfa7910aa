"""Removal of repeated byte strings with per-shard suffix arrays.

Every byte covered by a string of ``length`` bytes (a window) that also starts elsewhere goes. Equal windows
have the same smallest hash of their 16-byte grams, so windows are dealt by that hash: a maximal run of windows
of one text with the same smallest hash is a stretch, and all windows equal to one of its own lie in stretches
of the same hash. A hash that occurs once, in a stretch with one gram of that hash, has nothing to find. Stretches of equal bytes are one content; a content
that occurs twice is repeated as a whole. Where a hash has several contents, they are dealt to shards of bounded
size, whole hashes together. Each shard sorts its suffixes by Larsson-Sadakane refinement, ranks of 7 bytes being
doubled until no two are tied, and finds the common prefixes of neighbours by Kasai's scan. Windows between
which no common prefix is shorter than a window are equal.

A hash with more contents than a shard takes is split over shards. Its windows that no neighbour matched are
merged across shards: their digests, dealt by value, are looked up in the sorted digests by binary search.

Null and empty texts have nothing to remove. Repeated rows are texts of their own and so repeat each other.
Extra columns are kept by ``cut_texts``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.storage import forget, free, stored
from meterline.llm.textbytes import U, chunks, mix, text_bytes

GRAM = 16
PORTION = 1 << 17  # bytes hashed at once, so that arrays stay in the processor's cache
LONGEST = 1024  # windows of a stretch; a longer run is cut
SHARD = 1 << 20  # bytes of one suffix array
LANE = 512  # consecutive starts that one lane of Kasai's scan walks
SPLIT = 8 << 20  # bytes of one hash's contents above which they are spread over shards

_BASE = 0x9E3779B97F4A7C15
_STRETCH = "doc_id long, text_hash long, start int, windows int, hash long, digest long, twice boolean"


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    h, size, c = data.astype(np.uint64) + U(1), 1, _BASE
    while size < GRAM:
        h[:-size] = h[:-size] * U(c) + h[size:]
        size, c = size * 2, c * c % (1 << 64)
    return mix(h)


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the next ``width`` entries, from each entry that has as many."""
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:len(h) - (width - size)], h[width - size:]) if size < width else h


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Begin, number of windows, row, hash, and whether the hash's gram comes twice, of the stretches of some texts."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, bool)
    width = length - GRAM + 1
    grams = _gram_hashes(data)[:len(data) - GRAM + 1]
    least = _smallest(grams, width)
    inside = np.zeros(len(least) + 1, bool)
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= length:
            inside[a:b - length + 1] = True
            new[a] = True
    new &= inside[:-1]
    begin = np.flatnonzero(new)
    closing = np.ones(len(least), bool)
    closing[:-1] = new[1:]
    closing |= ~inside[1:]
    end = np.flatnonzero(closing & inside[:-1]) + 1
    if len(begin) and (end - begin).max() > LONGEST:
        pieces = -(-(end - begin) // LONGEST)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, end = np.repeat(begin, pieces) + step * LONGEST, np.repeat(end, pieces)
        end = np.minimum(end, begin + LONGEST)
    # a gram is the smallest of some window if its hash is the largest of those windows' smallest hashes
    around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    around[width - 1:len(around) - width + 1] = np.where(inside[:-1], least, U(0))
    chosen = np.flatnonzero(~_smallest(~around, width) == grams)
    low = np.searchsorted(chosen, begin)
    count = np.searchsorted(chosen, end - 1 + width) - low
    stretch = np.repeat(np.arange(len(begin)), count)
    place = np.arange(len(stretch)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    same = grams[chosen[place]] == least[begin][stretch]
    twice = np.bincount(stretch[same], minlength=len(begin)) > 1
    return begin, end - begin, np.searchsorted(offsets, begin, "right") - 1, least[begin], twice


def _portions(data: np.ndarray, offsets: np.ndarray, length: int):
    """Texts in portions; a long text in overlapping parts, whose windows are those of the text."""
    for i, j in chunks(offsets, PORTION):
        begin, end = int(offsets[i]), int(offsets[j])
        if end - begin <= 2 * PORTION:
            yield i, 0, data[begin:end], offsets[i:j + 1] - begin
            continue
        for at in range(begin, max(begin + 1, end - length + 1), PORTION):
            part = data[at:min(end, at + PORTION + length - 1)]
            yield i, at - begin, part, np.array([0, len(part)])


def _stretches(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            doc, text = batch.column(0), batch.column(1).to_numpy()
            for row, shift, part, places in _portions(data, offsets, length):
                begin, windows, rows, least, twice = stretches(part, places, length)
                raw = part.tobytes()
                digest = np.array([xxhash.xxh3_64_intdigest(raw[b:b + n + length - 1]) for b, n in zip(begin.tolist(), windows.tolist())], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [doc.take(pa.array(rows + row)), pa.array(text[rows + row]), pa.array((begin - places[rows] + shift).astype(np.int32)),
                     pa.array(windows.astype(np.int32)), pa.array(least.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(twice)],
                    names=["doc_id", "text_hash", "start", "windows", "hash", "digest", "twice"])
        pa.default_memory_pool().release_unused()  # the worker lives on beside the executor's other stages
    return run


def _contents(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, marks in zip(batch.column(0), batch.column(1)):
                raw = (text.as_py() or "").encode()
                marks = marks.values
                columns = {f: marks.field(f).to_numpy() for f in ("start", "windows")}
                parts = [raw[s:s + n + length - 1] for s, n in zip(columns["start"].tolist(), columns["windows"].tolist())]
                yield pa.RecordBatch.from_arrays([*(marks.field(f) for f in ("hash", "digest", "shard", "n")), pa.array(parts, pa.binary())],
                                                 names=["hash", "digest", "shard", "n", "bytes"])
        pa.default_memory_pool().release_unused()
    return run


def _words(data: np.ndarray) -> np.ndarray:
    """The 7 bytes from each place on as a number, 0 for bytes after the end."""
    n = len(data)
    words = np.zeros(n, np.uint64)
    for k in range(7):
        words <<= U(8)
        words[:max(0, n - k)] |= data[k:]
    return words


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes in order, the place of each, and each suffix's first 7 bytes as a number.

    Larsson-Sadakane refinement: ranks by the first 7 bytes, then by twice as many, sorting again only what is
    still tied, until nothing is. A suffix that ends comes before its continuations.
    """
    n = len(data)
    key = _words(data)
    key <<= U(8)
    key |= U(7)
    key[max(0, n - 7):] += np.arange(min(n, 7), 0, -1).astype(np.uint64) - U(7)
    order = np.argsort(key).astype(np.int32)
    key = key[order]
    first = np.ones(n, bool)
    first[1:] = key[1:] != key[:-1]
    del key
    rank = np.zeros(n + 1, np.int32)  # the last entry stands for all places after the end
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n, dtype=np.int32), np.int32(0))) + 1
    size = 7
    last = np.ones(n, bool)
    last[:-1] = first[1:]
    tied = np.flatnonzero(~(first & last)).astype(np.int32)  # places in the order that share a rank
    del first, last
    while len(tied):
        at = order[tied]
        pair = rank[at].astype(np.int64)
        pair <<= 32
        pair |= rank[np.minimum(at + np.int32(size), np.int32(n))]
        turn = np.argsort(pair)
        order[tied] = at[turn]
        del at
        pair = pair[turn]
        del turn
        fresh = np.ones(len(tied) + 1, bool)
        fresh[1:-1] = pair[1:] != pair[:-1]
        del pair
        rank[order[tied]] = np.maximum.accumulate(np.where(fresh[:-1], tied, np.int32(0))) + 1
        tied = tied[~(fresh[:-1] & fresh[1:])]
        size *= 2
    return order, rank[:n] - 1, _words(data)


def common_prefixes(order: np.ndarray, words: np.ndarray, most: int) -> np.ndarray:
    """Length of the prefix that each suffix, by its start, has in common with the one before it in order, up to ``most``.

    Kasai's scan: from one start to the next the prefix loses one byte at most, so only what may be new is compared.
    Lanes of ``LANE`` consecutive starts advance together, each with the prefix it carries, 7 bytes at a time.
    """
    n = len(order)
    before = np.full(n, n, np.int32)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int32)
    at = np.arange(0, n, LANE)
    same = np.zeros(len(at), np.int64)
    for _ in range(min(n, LANE)):
        if at[-1] >= n:
            at, same = at[:-1], same[:-1]
        other = before[at]
        room = np.minimum(n - np.maximum(at, other), most)
        same = np.maximum(same - 1, 0)
        lanes = np.flatnonzero(same < room)
        while len(lanes):
            unlike = words[at[lanes] + same[lanes]] ^ words[other[lanes] + same[lanes]]
            bits = np.frexp((unlike & ~(unlike >> U(1))).astype(np.float64))[1]  # the second bit is off: no rounding up
            gain = (56 - bits) >> 3
            same[lanes] += gain
            lanes = lanes[(gain == 7) & (same[lanes] < room[lanes])]
        same = np.minimum(same, room)
        out[at] = same
        at = at + 1
    return out


def window_classes(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows at ``starts`` in suffix order, and whether each has the whole window in common with the one before.

    Two windows are equal if all common prefixes from the one to the other in the order have their length.
    """
    order, place, words = suffix_array(data)
    classes = np.cumsum(common_prefixes(order, words, length)[order] < length, dtype=np.int32)
    del order, words
    places = place[starts]
    turn = np.argsort(places).astype(np.int32)
    mine = classes[places[turn]]
    same = np.zeros(len(starts), bool)
    same[1:] = mine[1:] == mine[:-1]
    return turn, same


def _shard_ranges(length: int):
    """Repeated windows of each content of a shard; for split hashes also the digests of the others."""
    def solve(rows: pa.Table):
        rows = rows.combine_chunks()
        keys, digests, shards, n = (rows.column(c).to_numpy() for c in ("hash", "digest", "shard", "n"))
        data, places = _binary(rows.column("bytes"))
        windows = np.diff(places) - length + 1
        # 32 bits are enough for places in a shard; the largest have several MB, so wider ones would tell
        owner = np.repeat(np.arange(len(windows), dtype=np.int32), windows)
        inner = np.arange(len(owner), dtype=np.int32) - np.repeat((np.cumsum(windows) - windows).astype(np.int32), windows)
        starts = places.astype(np.int32)[owner] + inner
        turn, same = window_classes(data, starts, length)
        repeated = np.zeros(len(starts), bool)
        repeated[turn[same]] = True
        repeated[turn[np.flatnonzero(same) - 1]] = True
        repeated |= n[owner] > 1
        split = shards[owner] >= 0
        yield _ranges(keys, digests, owner, inner, repeated)
        if split.any():
            heads = turn[~same]  # one window of each class stands for it
            heads = heads[split[heads]]
            a, b = _window_digests(data, starts[heads], length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[owner[heads]]), pa.array(digests[owner[heads]]), pa.array(inner[heads].astype(np.int32)),
                 pa.array(np.full(len(heads), -1, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            key, shard = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            length_of = np.diff(_binary(batch.column(4))[1])
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (shard[1:] != shard[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                more = int(length_of[a:b].sum())
                if held and size + more > SHARD and (key[a], shard[a]) != last:
                    yield from solve(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += more
                last = (key[a], shard[a])
        if held:
            yield from solve(pa.Table.from_batches(held))
            held = []
        pa.default_memory_pool().release_unused()
    return run


_FOUND = ["hash", "digest", "first", "last", "a", "b"]
_FOUND_TYPE = "hash long, digest long, first int, last int, a long, b long"


def _binary(column) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _ranges(keys, digests, owner, inner, repeated) -> pa.RecordBatch:
    """Runs of repeated windows, by content: first window, and the one after the last."""
    on = repeated.copy()
    on[1:] &= ~(repeated[:-1] & (owner[1:] == owner[:-1]))
    off = repeated.copy()
    off[:-1] &= ~(repeated[1:] & (owner[1:] == owner[:-1]))
    begin, end = np.flatnonzero(on), np.flatnonzero(off)
    null = pa.nulls(len(begin), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[owner[begin]]), pa.array(digests[owner[begin]]), pa.array(inner[begin].astype(np.int32)),
         pa.array((inner[end] + 1).astype(np.int32)), null, null], names=_FOUND)


def _window_digests(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each window."""
    out = []
    for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        up, down = np.full(len(data) + 1, base, np.uint64), np.full(len(data) + 1, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        up, down = np.cumprod(up), np.cumprod(down)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + U(1)) * up[:-1], out=sums[1:])
        out.append(mix((sums[starts + length] - sums[starts]) * down[starts]))
    return out[0], out[1]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of split hashes that occur in several shards; rows of equal digests are in one task."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    rows = pa.Table.from_batches(tables).combine_chunks()
    a, b = (rows.column(c).to_numpy() for c in ("a", "b"))
    both = mix(a.view(np.uint64)) ^ b.view(np.uint64)
    ordered = np.sort(both)
    often = np.searchsorted(ordered, both, "right") - np.searchsorted(ordered, both, "left") > 1
    found = rows.filter(pa.array(often))
    first = found.column("first").to_numpy()
    yield pa.RecordBatch.from_arrays([*(found.column(c).combine_chunks() for c in ("hash", "digest", "first")), pa.array(first + 1)],
                                     names=["hash", "digest", "first", "last"])


def repeated_ranges(docs: DataFrame, length: int = 200, split: int = SPLIT) -> DataFrame:
    """doc_id, text_hash, ranges: bytes [b, e) of repeated windows, for the texts that have any."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    every = stored(keyed.mapInArrow(_stretches(length), _STRETCH), "stretches")
    often = (every.groupBy("hash").agg(F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"),
                                       F.bool_or("twice").alias("twice"))
             .where("n > 1 or twice").select("hash", (F.col("twice") | (F.col("low") < F.col("high"))).alias("several")))
    shared = stored(every.drop("twice").join(often, "hash"), "shared-stretches")
    forget(every)
    contents = shared.where("several").groupBy("hash", "digest").agg(
        F.least(F.count("*"), F.lit(2)).cast("int").alias("n"), F.min(F.struct("doc_id", "text_hash", "start", "windows")).alias("at"))
    contents = stored(contents.select("hash", "digest", "n", "at.*"), "contents")
    large = (contents.groupBy("hash").agg(F.sum(F.col("windows") + length).alias("size")).where(F.col("size") > split)
             .select("hash", F.ceil(F.col("size") / split).alias("shards")))
    shard = F.when(F.col("shards").isNull(), F.lit(-1)).otherwise(F.pmod("digest", "shards")).cast("int")
    marks = (contents.join(large, "hash", "left").withColumn("shard", shard).groupBy("doc_id", "text_hash")
             .agg(F.collect_list(F.struct("start", "windows", "hash", "digest", "shard", "n")).alias("marks")))
    named = keyed.withColumnRenamed("text_hash", "th").withColumnRenamed("doc_id", "id")
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("th") == F.col("text_hash"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = (named.join(marks, same).select("text", "marks")
              .mapInArrow(_contents(length), "hash long, digest long, shard int, n int, bytes binary"))
    found = stored(pieces.repartition(tasks, "hash", "shard").sortWithinPartitions("hash", "shard")
                   .mapInArrow(_shard_ranges(length), _FOUND_TYPE), "repeated-windows")
    forget(contents)
    inside = found.where("a is null").select("hash", "digest", "first", "last")
    across = (found.where("a is not null").repartition(tasks, "a", "b")
              .mapInArrow(_merged, "hash long, digest long, first int, last int"))
    runs = inside.unionByName(across).join(shared.where("several"), ["hash", "digest"]).select(
        "doc_id", "text_hash", (F.col("start") + F.col("first")).alias("b"), (F.col("start") + F.col("last") + length - 1).alias("e"))
    copies = shared.where("not several").select("doc_id", "text_hash", F.col("start").alias("b"),
                                                (F.col("start") + F.col("windows") + length - 1).alias("e"))
    out = stored(runs.unionByName(copies).distinct().groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("b", "e")).alias("ranges")), "ranges")
    forget(found)
    forget(shared)
    return out


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for b, e in sorted(ranges):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [(b, e) for b, e in out]


CUT = ("kept_bytes", "n_bytes", "n_removed", "n_spans")


def _with_ranges(docs: DataFrame, length: int, split: int) -> DataFrame:
    """The documents and, as the last column, the ranges of their repeated windows."""
    names = docs.columns
    id_, hash_, found_ = (free(c, names) for c in ("range_id", "range_hash", "ranges"))
    ranges = repeated_ranges(docs, length, split).select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("ranges").alias(found_))
    joined = docs.join(ranges, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_)), "left")
    return joined.select(*(F.col(f"`{c}`") for c in names), found_)


def _cut(text: pa.Scalar, found: pa.Scalar) -> tuple[bytes, int, list[tuple[int, int]]]:
    """The bytes that are left of a text, its size, and the maximal runs removed."""
    raw = (text.as_py() or "").encode()
    marks = found.values
    runs = merge(list(zip(marks.field("b").to_pylist(), marks.field("e").to_pylist()))) if found.is_valid else []
    ends = [0, *(e for _, e in runs)]
    return b"".join(raw[a:b] for a, b in zip(ends, [*(b for b, _ in runs), len(raw)])), len(raw), runs


def cut_texts(docs: DataFrame, length: int = 200, split: int = SPLIT, added: tuple[str, ...] = CUT) -> DataFrame:
    """The documents with the bytes that are left, the size, the bytes and the maximal runs removed.

    ``added`` names the new columns; an input column of such a name is replaced.
    """
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added))
    names = docs.columns
    fields = [T.StructField(c, T.BinaryType() if k == 0 else T.LongType()) for k, c in enumerate(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed, spans = [], [], [], []
            for text, found in zip(batch.column(names.index("text")), batch.column(len(names))):
                left, size, runs = _cut(text, found)
                kept.append(left)
                sizes.append(size)
                removed.append(sum(e - b for b, e in runs))
                spans.append(len(runs))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(kept, pa.binary()), *(pa.array(c, pa.int64()) for c in (sizes, removed, spans))],
                names=[*names, *added])
        pa.default_memory_pool().release_unused()
    return _with_ranges(docs, length, split).mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def without_repeats(docs: DataFrame, length: int = 200, split: int = SPLIT) -> DataFrame:
    """The documents with what is left of their texts; a character that lost some of its bytes goes with them.

    Texts are cut and decoded in one Python step: a second one would have a worker of its own in each task.
    """
    names, place = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[:len(names)])
            columns[place] = pa.array([_cut(t, found)[0].decode(errors="ignore") if t.is_valid else None
                                       for t, found in zip(columns[place], batch.column(len(names)))], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)
        pa.default_memory_pool().release_unused()
    return _with_ranges(docs, length, split).mapInArrow(run, docs.schema)
