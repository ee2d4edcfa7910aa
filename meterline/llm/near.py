"""MinHash near-dedup with HyperMinHash sketches.

A text is the set of its distinct word shingles. Its sketch has a register per bucket: of the smallest hash in
the bucket it keeps the number of leading zeros and a few mantissa bits after them, 16 bits in all. Bands of
registers are hashed to keys; texts that share a key are candidates. Every link is confirmed on full sets.

Texts with equal sets are one class from the start, so copies never meet each other. Among the classes that
share a key, a collision-corrected estimate from the registers decides which pairs could be similar enough, and
full sets decide:

1. each class is held against the class it shares most keys with among the smallest of each key;
2. classes with the same closest class form a family, dealt to blocks of bounded size. Where the classes of a
   key are still in several components, their registers are compared, in pieces of bounded size for a large
   key, and give the pairs of blocks that hold a pair which could be similar enough. Only these blocks
   meet with full sets. Members of one component are not compared, and a task returns no more links than it
   has members, however many pairs are similar.

Classes have numbers of their own, given once when they are written, so an id may stand in several classes and a
class need not have an id. Rows that share an id, with whatever texts, are one document: all links of its texts
are links of the id. Rows without id are documents of their own; their texts link like any other, their component is
the smallest id they reach (null if none), and they are always kept, since nothing names them. Null and empty texts
have no set and link with nothing, whatever their id. Repeated rows each give a row. Very long texts are cut into
shingles whole, batch by batch. Ties for the closest class go to the smaller number, which changes no result. Extra
columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.components import components
from meterline.llm.storage import forget, stored
from meterline.llm.textbytes import U, Words, chunks, mix, shingles, text_bytes

REGISTERS = 128
BAND = 4  # registers of a key: 32 keys, which miss a pair at similarity 0.75 with probability 5e-6
MANTISSA = 10
MARGIN = 6.0  # standard deviations an estimate may lie below the threshold
BLOCK = 256  # classes of a family in one block
PIECE = 1024  # classes of a key compared in one piece
PAIRS = 25_000  # estimates computed at once
MET = 1 << 18  # pairs of blocks a task holds to give each of them once

SAME = ["digest_a", "digest_b", "n"]  # equal for equal sets
SKETCH = "doc_id long, n long, digest_a long, digest_b long, registers binary, keys array<long>"


def registers(value: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """HyperMinHash registers of each row's hashes; 0 is an empty bucket."""
    bucket = (value >> U(57)).astype(np.int64)
    low = value & U((1 << 57) - 1)
    least = np.full(rows * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, row * REGISTERS + bucket, low)
    full = least != np.iinfo(np.uint64).max
    v = np.where(full, least, U(1))
    _, exponent = np.frexp(v.astype(np.float64))  # v < 2**exponent; rounding up to a power only moves a mantissa
    width = np.minimum(exponent, 57).astype(np.int64)
    zeros = np.minimum(57 - width, 62)
    shift = width - 1 - MANTISSA
    rest = np.where(shift >= 0, v >> np.maximum(shift, 0).astype(np.uint64), v << np.maximum(-shift, 0).astype(np.uint64))
    mantissa = (rest & U((1 << MANTISSA) - 1)).astype(np.int64)
    packed = (zeros << MANTISSA) + mantissa + 1
    return np.where(full, packed, 0).astype(np.uint16).reshape(rows, REGISTERS)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A key for every band of registers, 0 where the whole band is empty."""
    parts = sketch.reshape(len(sketch), REGISTERS // BAND, BAND).astype(np.uint64)
    key = np.arange(REGISTERS // BAND, dtype=np.uint64)[None, :] + U(1)
    for j in range(BAND):
        key = mix(key * U(0x9E3779B97F4A7C15) + parts[:, :, j])
    return np.where(parts.any(axis=2), key | U(1), U(0))


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers two disjoint sets of n and m hashes are expected to share by chance.

    For sets much larger than the number of registers the chance per register tends to 0.17 * 2**-MANTISSA at
    equal sizes and falls with their ratio; smaller sets leave buckets empty and collide less.
    """
    ratio = n / m
    filled = (1 - np.exp(-n / REGISTERS)) * (1 - np.exp(-m / REGISTERS))
    return 0.1699 * REGISTERS * 2.0 ** -MANTISSA * 4 * ratio / (1 + ratio) ** 2 * filled


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected similarity of each row of a with the same row of b, and the registers it rests on."""
    used = np.maximum(((a | b) > 0).sum(axis=1), 1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    return np.clip((same - expected_collisions(n, m)) / used, 0, 1), used


def sketches(docs: DataFrame, words: int = 5) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in chunks(offsets):
                value, row = shingles(Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]), words)
                n = np.bincount(row, minlength=j - i)
                sketch = registers(value, row, j - i)
                keys = band_keys(sketch)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), *_digests(value, row, j - i),
                     pa.array([s.tobytes() for s in sketch], pa.binary()),
                     pa.array([k[k > 0].view(np.int64) for k in keys], pa.list_(pa.int64()))],
                    names=["doc_id", "n", "digest_a", "digest_b", "registers", "keys"])
        pa.default_memory_pool().release_unused()
    return docs.select("doc_id", "text").mapInArrow(run, SKETCH)


def _digests(value: np.ndarray, row: np.ndarray, rows: int) -> list[pa.Array]:
    """Two digests of each row's set, whatever the order of its hashes."""
    out = [np.zeros(rows, np.uint64) for _ in range(2)]
    for digest, salt in zip(out, (U(0x1F83D9ABFB41BD6B), U(0x5BE0CD19137E2179))):
        np.add.at(digest, row, mix(value ^ salt))
    return [pa.array(d.view(np.int64)) for d in out]


def full_sets(docs: DataFrame, words: int = 5) -> DataFrame:
    """Digests, size and shingle hashes of whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in chunks(offsets):
                value, row = shingles(Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]), words)
                cuts = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [*_digests(value, row, j - i), pa.array(np.diff(cuts), pa.int64()),
                     pa.LargeListArray.from_arrays(cuts, value.view(np.int64)).cast(pa.list_(pa.int64()))],
                    names=[*SAME, "shingles"])
        pa.default_memory_pool().release_unused()
    return docs.select("doc_id", "text").mapInArrow(run, "digest_a long, digest_b long, n long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those whose full sets reach the similarity."""
    one = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    two = one.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    shared = F.size(F.array_intersect("x", "y"))
    return (two.withColumn("shared", shared)
            .where(100 * F.col("shared") >= percent * (F.size("x") + F.size("y") - F.col("shared"))).select("a", "b"))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of rows that come sorted by the keys, one after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            if held and last != values[:, begin].tolist():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = values[:, begin].tolist()
    if held:
        yield pa.Table.from_batches(held)


def _hopeful(rows: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, level: float) -> np.ndarray:
    """Which pairs of rows may reach the similarity, by the sizes of their sets and their registers."""
    n = rows["n"]
    fit = (rows["component"][x] != rows["component"][y]) & (np.minimum(n[x], n[y]) >= level * np.maximum(n[x], n[y]))
    for begin in range(0, len(x), PAIRS):
        some = begin + np.flatnonzero(fit[begin:begin + PAIRS])
        value, used = estimate(rows["registers"][x[some]], rows["registers"][y[some]], n[x[some]], n[y[some]])
        fit[some] = value + MARGIN * np.sqrt(level * (1 - level) / used) >= level
    return fit


def _shared(value: np.ndarray, row: np.ndarray, left: np.ndarray, rows: int) -> np.ndarray:
    """How many set elements each left row shares with each other row (rows x rows)."""
    order = np.argsort(value, kind="stable")
    value, row = value[order], row[order]
    begin = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    count = np.diff(np.append(begin, len(value)))
    span = np.repeat(count, count)
    start = np.repeat(begin, count)
    mine = np.flatnonzero(left[row] & (span > 1))
    total = np.zeros(rows * rows, np.int64)
    ends = np.cumsum(span[mine])
    done = 0
    while done < len(mine):
        stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + 20 * PAIRS, "right")))
        width = span[mine[done:stop]]
        other = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(start[mine[done:stop]], width)
        total += np.bincount(np.repeat(row[mine[done:stop]], width) * rows + row[other], minlength=rows * rows)
        done = stop
    return total.reshape(rows, rows)


def _linked(percent: int):
    """Links between components found in one pair of blocks, just enough of them to join what belongs together."""
    level = percent / 100

    def links(table: pa.Table) -> list[tuple[int, int]]:
        table = table.combine_chunks()
        rows = {c: table.column(c).to_numpy() for c in ("id", "n", "component", "side")}
        rows["registers"] = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        left, right = np.flatnonzero(rows["side"] == 0), np.flatnonzero(rows["side"] == 1)
        if not len(right):  # a block met with itself
            x, y = np.triu_indices(len(left), 1)
        else:
            x, y = np.repeat(left, len(right)), np.tile(right, len(left))
        hope = _hopeful(rows, x, y, level)
        x, y = x[hope], y[hope]
        if not len(x):
            return []
        used, place = np.unique(np.concatenate([x, y]), return_inverse=True)
        sets = table.column("shingles").combine_chunks().take(pa.array(used))
        lengths = np.diff(sets.offsets.to_numpy())
        first = np.zeros(len(used), bool)
        first[place[:len(x)]] = True
        both = _shared(sets.flatten().to_numpy(), np.repeat(np.arange(len(used)), lengths), first, len(used))
        p, q = place[:len(x)], place[len(x):]
        same = both[p, q]
        found = 100 * same >= percent * (lengths[p] + lengths[q] - same)
        parent: dict[int, int] = {}

        def top(c: int) -> int:
            while parent.setdefault(c, c) != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c
        component, ids = rows["component"], rows["id"]
        out = []
        pairs = np.unique(np.stack([component[x[found]], component[y[found]]]), axis=1, return_index=True)[1]
        for k in np.flatnonzero(found)[pairs]:
            a, b = top(int(component[x[k]])), top(int(component[y[k]]))
            if a != b:
                parent[a] = b
                out.append((int(min(ids[x[k]], ids[y[k]])), int(max(ids[x[k]], ids[y[k]]))))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["i", "j"]):
            out = links(table)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])
    return run


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows that come sorted by the keys, many small groups at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys])
        if held and last != values[:, 0].tolist():
            yield pa.Table.from_batches(held)
            held = []
        changes = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        cut = int(changes[-1]) if len(changes) else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
        last = values[:, -1].tolist()
    if held:
        yield pa.Table.from_batches(held)


def _promising_blocks(percent: int):
    """Pairs of blocks with a pair of classes that share a key and may be similar, of different components.

    Two blocks meet under many keys; a task gives a pair of them once, or again after ``MET`` others.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, held = [np.zeros((2, 0), np.int64)], 0
        for table in _runs(batches, ["key", "i", "j"]):
            table = table.combine_chunks()
            key, i, j, block, left = (table.column(c).to_numpy() for c in ("key", "i", "j", "block", "left"))
            rows = {c: table.column(c).to_numpy() for c in ("n", "component")}
            rows["registers"] = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            begins = np.append(np.flatnonzero(new), len(key))
            group = np.cumsum(new) - 1
            lefts = np.flatnonzero(left)
            span = begins[group[lefts] + 1] - begins[group[lefts]]
            ends = np.cumsum(span)
            done = 0
            while done < len(lefts):
                stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS, "right")))
                some, width = lefts[done:stop], span[done:stop]
                x = np.repeat(some, width)
                y = np.arange(len(x)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(begins[group[some]], width)
                other = ~left[y]
                x, y = x[other], y[other]
                hope = _hopeful(rows, x, y, percent / 100)
                p, q = np.minimum(block[x[hope]], block[y[hope]]), np.maximum(block[x[hope]], block[y[hope]])
                if len(p):
                    met.append(np.unique(np.stack([p, q]), axis=1))
                    held += met[-1].shape[1]
                if held >= 2 * MET:
                    met = [np.unique(np.concatenate(met, axis=1), axis=1)]
                    held = met[0].shape[1]
                    if held >= MET:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, met[0])), names=["i", "j"])
                        met, held = [np.zeros((2, 0), np.int64)], 0
                done = stop
        yield pa.RecordBatch.from_arrays(list(map(pa.array, np.unique(np.concatenate(met, axis=1), axis=1))), names=["i", "j"])
    return run


def _promising(percent: int):
    """Pairs (a, b) whose registers leave the similarity possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m = (batch.column(k).to_numpy() for k in range(4))
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (4, 5))
            rows = {"n": np.concatenate([n, m]), "registers": np.concatenate([x, y]), "component": np.concatenate([a, b])}
            keep = pa.array(_hopeful(rows, np.arange(len(a)), len(a) + np.arange(len(a)), percent / 100))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, percent: int = 75, words: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    drawn = stored(sketches(docs, words), "sketches")
    heads = drawn.where("n > 0").groupBy(*SAME).agg(F.min("doc_id").alias("head"))
    classes = stored(drawn.where("n > 0").join(heads, SAME).where(F.col("doc_id").eqNullSafe(F.col("head")))
                     .dropDuplicates(SAME)
                     .select(F.monotonically_increasing_id().alias("id"), "head", *SAME, "registers", "keys"), "classes")
    keyed = classes.select("id", F.explode("keys").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("size")).where("size > 1")
    shared = stored(keyed.join(hubs, "key"), "keys")
    first = shared.where("id > hub").groupBy("hub", "id").agg(F.count("*").alias("times"))
    first = stored(first, "hubs")

    wanted = classes.join(shared.select("id").distinct(), "id", "left_semi").select("id", "head", *SAME)
    read = docs.select("doc_id", "text")
    read = (read.join(wanted.select("head"), F.col("doc_id") == F.col("head"), "left_semi")
            .unionByName(read.where(F.col("doc_id").isNull())))
    sets = stored(full_sets(read, words).dropDuplicates(SAME).join(wanted, SAME).select("id", "shingles"), "sets")
    closest = first.groupBy("id").agg(F.max_by("hub", F.struct("times", -F.col("hub"))).alias("hub"))
    known = classes.select("id", "n", "registers")
    pairs = (closest.join(known, "id").select(F.col("hub").alias("a"), F.col("id").alias("b"), F.col("n").alias("m"), F.col("registers").alias("y"))
             .join(known.withColumnRenamed("id", "a"), "a").select("a", "b", "n", "m", F.col("registers").alias("x"), "y")
             .mapInArrow(_promising(percent), "a long, b long"))
    links = stored(confirmed(pairs, sets, percent), "links-1")

    def labelled(frame: DataFrame, column: str, label: str, found: DataFrame) -> DataFrame:
        named = found.select(F.col("id").alias(column), F.col("component").alias(label))
        return frame.join(named, column, "left").withColumn(label, F.coalesce(label, column))

    found = components(links)
    family = F.coalesce("hub", "id")
    members = labelled(shared.select("id").distinct().join(closest, "id", "left")
                       .select("id", family.alias("family")), "id", "component", found)
    members = stored(members.join(known, "id"), "members")
    mains = (members.groupBy("family", "component").agg(F.count("*").alias("size"))
             .groupBy("family").agg(F.max_by("component", F.struct("size", -F.col("component"))).alias("main"), F.sum("size").alias("size")))
    dealt = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK))
    members = stored(members.join(mains, "family").select(
        "id", "component", "n", "registers", F.xxhash64("family", F.col("component") == F.col("main"), dealt).alias("block")), "blocks")

    keys = shared.select("key", "id").join(members.select("id", "component"), "id")
    mixed = (keys.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select("key"))
    mixed = stored(keys.join(mixed, "key", "left_semi").select("key", "id", "component"), "mixed-keys")
    # of the components of a key the largest is settled; the classes of the others are held against all
    tallies = (mixed.groupBy("key", "component").agg(F.count("*").alias("size"))
               .groupBy("key").agg(F.max_by("component", F.struct("size", -F.col("component"))).alias("main"),
                                   F.max("size").alias("most"), F.sum("size").alias("size")))
    across, along = (F.ceil(c / PIECE).cast("int") for c in (F.col("size") - F.col("most"), F.col("size")))
    rows = stored(mixed.join(tallies, "key").select(
        "key", "id", (F.col("component") == F.col("main")).alias("settled"), across.alias("across"), along.alias("along")), "dealt-keys")
    place, each = (lambda c: F.pmod(F.xxhash64("id"), c).cast("int")), (lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1)))
    loose = rows.where(~F.col("settled")).select("key", "id", place("across").alias("i"), each("along").alias("j"), F.lit(True).alias("left"))
    others = rows.select("key", "id", each("across").alias("i"), place("along").alias("j"), F.lit(False).alias("left"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = (loose.unionByName(others).join(members, "id").select("key", "i", "j", "left", "component", "n", "registers", "block")
           .repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j")
           .mapInArrow(_promising_blocks(percent), "i long, j long").distinct())
    met = stored(met, "block-pairs")
    touched = met.select(F.explode(F.array("i", "j")).alias("block")).distinct()
    assigned = stored(members.join(touched, "block").join(sets, "id"), "assigned")
    carried = ["id", "component", "n", "registers", "shingles"]
    sides = [met.where("i <> j" if side else "true").join(assigned.withColumnRenamed("block", c), c)
             .select("i", "j", F.lit(side).alias("side"), *carried) for side, c in ((0, "i"), (1, "j"))]
    more = (sides[0].unionByName(sides[1]).repartition(tasks, "i", "j").sortWithinPartitions("i", "j")
            .mapInArrow(_linked(percent), "a long, b long"))
    links = stored(links.unionByName(more), "links-2")
    # texts of one id belong together
    several = (drawn.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id")
               .agg(*(f(c).alias(f"{g}_{c}") for c in SAME for g, f in (("low", F.min), ("high", F.max))))
               .where(" OR ".join(f"low_{c} < high_{c}" for c in SAME)).select("doc_id"))
    texts = stored(drawn.where("n > 0").join(several, "doc_id", "left_semi").select("doc_id", *SAME).distinct()
                   .join(classes.select("id", *SAME), SAME).select("doc_id", "id"), "texts-of-ids")
    joint = texts.groupBy("doc_id").agg(F.min("id").alias("a")).join(texts, "doc_id").where("a < id").select("a", F.col("id").alias("b"))
    found = components(links.unionByName(joint))

    numbered = classes.select("id", "head", *SAME)
    linked = stored(found.join(numbered, "id").select("id", "component", "head"), "linked")
    least = linked.groupBy("component").agg(F.min("head").alias("least"))
    rooted = stored(numbered.join(linked.join(least, "component").select("id", "least"), "id", "left")
                    .select(*SAME, F.coalesce("least", "head").alias("root")), "roots")
    out = drawn.select("doc_id", *SAME).join(rooted, SAME, "left")
    for frame in (shared, first, sets, members, mixed, rows, assigned, met, classes, texts, links, linked):
        forget(frame)
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
