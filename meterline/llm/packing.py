"""Best-fit packing of token pieces with a grouping genetic algorithm on islands.

Documents become pieces of at most ``length`` tokens. Pieces shorter than that are dealt to shards of a
bounded number of pieces; every shard is a packing problem that several islands evolve from different
starting points. A crossover injects well-filled bins of one parent into the other, takes out the bins that
hold any of the injected pieces, and best-fits the displaced pieces. Between rounds each island sends its
elite to the next one. Bins that stay under-filled are then dealt anew, whole, and evolved once more
together with those of other shards, starting from the packing they came with, so a level never gets worse.

Null and empty texts are a piece with the end token alone. Repeated rows are packed as often as they occur.
An empty table gives no rows. Columns of the input other than the id, the text and a named order are not looked at.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import stored

SHARD_PIECES = 8192  # pieces of one packing problem
ISLANDS = 2
ROUNDS = 2
GENERATIONS = 12
POPULATION = 4
FULL_ENOUGH = 0.99  # bins below this fill are dealt anew on the second level

PIECES = ("doc_id long, place long, piece int, start long, length int, ids_crc32 long")
ELITE = "shard long, island int, uids array<long>, lengths array<int>, bins array<int>, n_bins int, fill double"

_ENCODINGS: dict[str, object] = {}


def encoder(ranks_file: str):
    """The byte-level BPE whose ranks the file lists, with the added tokens of the JSON file beside it."""
    if ranks_file not in _ENCODINGS:
        import base64
        import json

        import public_tokenizers
        import tiktoken
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        with open(f"{ranks_file.rpartition('.')[0]}.json", encoding="utf-8") as file:
            added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
        _ENCODINGS[ranks_file] = tiktoken.Encoding(
            "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return _ENCODINGS[ranks_file]


def token_ids(ranks_file: str, text: str) -> list[int]:
    """The ids that tokenizers gives with add_special_tokens=False: strings of added tokens are those tokens."""
    return encoder(ranks_file).encode(text, allowed_special="all")


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens: all full, only the first may be shorter."""
    first = n if n <= length else (n % length or length)
    return [(0, first)] + [(s, length) for s in range(first, n, length)]


def token_pieces(docs: DataFrame, ranks_file: str, length: int, end_id: int) -> DataFrame:
    """One row per piece of every document (doc_id, text): place in the document, length and checksum of its ids.

    A third column is the document's own place, 0 without it.
    """
    docs = docs if len(docs.columns) > 2 else docs.withColumn("place", F.lit(0).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, place in zip(batch.column(0), batch.column(1), batch.column(2)):
                ids = token_ids(ranks_file, text.as_py() or "")
                ids.append(end_id)
                packed = np.array(ids, "<u4")
                out += [(doc.as_py(), place.as_py(), k, s, n, zlib.crc32(packed[s:s + n].tobytes()))
                        for k, (s, n) in enumerate(cut(len(ids), length))]
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()))],
                    names=["doc_id", "place", "piece", "start", "length", "ids_crc32"])
    return docs.mapInArrow(run, PIECES)


Bin = tuple[int, tuple[int, ...]]  # load and items
Packing = list[Bin]


def best_fit(order: list[int], sizes: list[int], capacity: int, kept: Packing = ()) -> Packing:
    """Put the items, in this order, where the least sufficient room is; finding it is a bit search."""
    full = [b for b in kept if b[0] == capacity]
    by_room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for load, items in kept:
        if load < capacity:
            by_room[capacity - load].append(list(items))
            mask |= 1 << (capacity - load)
    for item in order:
        size = sizes[item]
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            items = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
            items.append(item)
        else:
            room, items = capacity, [item]
        by_room[room - size].append(items)
        mask |= 1 << (room - size)
    return full + [(capacity - room, tuple(items)) for room, bins in enumerate(by_room) for items in bins]


def score(packing: Packing, capacity: int) -> tuple[int, float]:
    """Fewer bins first; among equals the more uneven fill, which leaves room that can be used."""
    return len(packing), -sum(load * load for load, _ in packing) / (capacity * capacity * max(1, len(packing)))


def crossover(into: Packing, source: Packing, sizes: list[int], capacity: int, rng: random.Random) -> Packing:
    """Whole well-filled bins of ``source`` enter ``into``; what they displace is best-fitted."""
    ranked = sorted(source, reverse=True)[:max(1, len(source) // 2)]
    injected = rng.sample(ranked, max(1, len(ranked) // 6))
    taken = {i for _, items in injected for i in items}
    kept, displaced = [], []
    for b in into:
        if taken.isdisjoint(b[1]):
            kept.append(b)
        else:
            displaced += [i for i in b[1] if i not in taken]
    kept.sort()
    loosened = max(1, len(kept) // 50)  # mutation: the emptiest bins are opened as well
    displaced += [i for _, items in kept[:loosened] for i in items]
    displaced.sort(key=sizes.__getitem__, reverse=True)
    return best_fit(displaced, sizes, capacity, injected + kept[loosened:])


def evolve(population: list[Packing], sizes: list[int], capacity: int, generations: int, rng: random.Random) -> Packing:
    floor = -(-sum(sizes) // capacity)
    ranked = sorted((score(p, capacity), k, p) for k, p in enumerate(population))
    births = len(ranked)
    for _ in range(generations):
        if ranked[0][0][0] <= floor or len(ranked) < 2:
            break  # no packing of these pieces has fewer bins
        a, b = rng.sample(ranked, 2)
        child = crossover(min(a, b)[2], max(a, b)[2], sizes, capacity, rng)
        births += 1
        ranked = sorted([*ranked, (score(child, capacity), births, child)])[:len(ranked)]
    return ranked[0][2]


def _elite(shard, island, uids, sizes, packing, capacity):
    bins = [0] * len(sizes)
    for b, (_, items) in enumerate(packing):
        for i in items:
            bins[i] = b
    n_bins, fill = score(packing, capacity)
    return {"shard": [shard], "island": [island], "uids": [uids], "lengths": [sizes], "bins": [bins],
            "n_bins": [n_bins], "fill": [fill]}


def _grouped(sizes: list[int], bins: list[int]) -> Packing:
    by: dict[int, list[int]] = {}
    for i, b in enumerate(bins):
        by.setdefault(b, []).append(i)
    return [(sum(sizes[i] for i in items), tuple(items)) for items in by.values()]


_ELITE_ARROW = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("uids", pa.list_(pa.int64())),
                          ("lengths", pa.list_(pa.int32())), ("bins", pa.list_(pa.int32())), ("n_bins", pa.int32()),
                          ("fill", pa.float64())])


def _settle(capacity: int):
    """First packings of a shard on one island, from the seed packing and from best-fit in several orders."""
    def run(key, group):
        shard, island = key[0].as_py(), key[1].as_py()
        group = group.sort_by("uid")
        uids, sizes, seeds = (group.column(c).to_pylist() for c in ("uid", "length", "seed"))
        rng = random.Random(f"{shard} {island} settle")
        down = sorted(range(len(sizes)), key=lambda i: -sizes[i])
        population = [best_fit(down, sizes, capacity)]
        if seeds[0] is not None:
            population.append(_grouped(sizes, seeds))
        while len(population) < POPULATION:
            spread = rng.uniform(0.05, 0.4) * capacity
            jitter = [sizes[i] + rng.uniform(-spread, spread) for i in range(len(sizes))]
            population.append(best_fit(sorted(down, key=lambda i: -jitter[i]), sizes, capacity))
        best = evolve(population, sizes, capacity, GENERATIONS, rng)
        return pa.table(_elite(shard, island, uids, sizes, best, capacity), schema=_ELITE_ARROW)
    return run


def _migrated(capacity: int, turn: int):
    """An island's elite meets the elite of its neighbour."""
    def run(key, group):
        shard, island = key[0].as_py(), key[1].as_py()
        rows = sorted(group.to_pylist(), key=lambda r: (r["n_bins"], r["fill"], r["island"]))
        uids, sizes = rows[0]["uids"], rows[0]["lengths"]
        population = [_grouped(sizes, r["bins"]) for r in rows]
        best = evolve(population, sizes, capacity, GENERATIONS, random.Random(f"{shard} {island} {turn}"))
        return pa.table(_elite(shard, island, uids, sizes, best, capacity), schema=_ELITE_ARROW)
    return run


def _placed(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                loads = [0] * r["n_bins"]
                offsets = []
                for n, b in zip(r["lengths"], r["bins"]):
                    offsets.append(loads[b])
                    loads[b] += n
                k = len(offsets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["uids"], pa.int64()), pa.array(r["lengths"], pa.int32()),
                     pa.array([(r["shard"] << 20) + b for b in r["bins"]], pa.int64()),
                     pa.array(offsets, pa.int64()), pa.array([loads[b] for b in r["bins"]], pa.int64())],
                    names=["uid", "length", "bin", "offset", "load"])
    return run


def pack_level(items: DataFrame, shards: DataFrame, capacity: int, name: str) -> DataFrame:
    """Pack (uid, length, seed, shard); returns uid, length, bin, offset, load of the best island of each shard."""
    islands = shards.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    elites = islands.repartition(tasks, "shard", "island").groupBy("shard", "island").applyInArrow(_settle(capacity), ELITE)
    for turn in range(ROUNDS):
        guests = elites.withColumn("to", F.explode(F.array("island", (F.col("island") + 1) % ISLANDS)))
        elites = guests.repartition(tasks, "shard", "to").groupBy("shard", "to").applyInArrow(_migrated(capacity, turn), ELITE)
    best = elites.groupBy("shard").agg(F.min_by(
        F.struct("uids", "lengths", "bins", "n_bins"), F.struct("n_bins", "fill", "island")).alias("b"))
    rows = best.select("shard", "b.*").mapInArrow(_placed(capacity), "uid long, length int, bin long, offset long, load long")
    return stored(rows, name)


def pack(docs: DataFrame, ranks_file: str, length: int = 1024, end_id: int = 2, order: str | None = None) -> DataFrame:
    """Pack the documents (doc_id, text) into sequences of at most ``length`` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. ``order`` names a column
    with each document's place, from 0 and below 2**40: sequences are then numbered in the order of their first piece,
    by place and piece.
    """
    place = F.lit(0) if order is None else F.col(order)
    pieces = stored(token_pieces(docs.select("doc_id", "text", place.cast("long").alias("place")), ranks_file, length, end_id)
                    .withColumn("uid", F.monotonically_increasing_id()), "pieces")
    short = pieces.where(F.col("length") < length).select("uid", "length")

    def dealt(items: DataFrame, by: str, count: int) -> DataFrame:
        return items.withColumn("shard", F.pmod(F.xxhash64(by), F.lit(max(1, -(-count // SHARD_PIECES)))))

    first = short.withColumn("seed", F.lit(None).cast("long"))
    one = pack_level(first, dealt(first, "uid", first.count()), length, "packed-one")
    loose = F.col("load") < int(FULL_ENOUGH * length)
    again = one.where(loose).select("uid", "length", F.col("bin").alias("seed"))
    two = pack_level(again, dealt(again, "seed", again.count()), length, "packed-two")
    level = F.lit(1 << 60)
    placed = (one.where(~loose).select("uid", F.col("bin").alias("sequence_id"), "offset")
              .unionByName(two.select("uid", (F.col("bin") + level).alias("sequence_id"), "offset")))
    full = pieces.where(F.col("length") == length).withColumns(
        {"sequence_id": F.col("uid") + F.lit(1 << 61), "offset": F.lit(0).cast("long")})
    columns = ["doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"]
    key = F.shiftleft("place", 20) + F.col("piece")
    parts = pieces.where(F.col("length") < length).join(placed, "uid")
    if order is not None:
        first = parts.groupBy("sequence_id").agg(F.min(key).alias("first"))
        parts = parts.join(first, "sequence_id").drop("sequence_id").withColumnRenamed("first", "sequence_id")
        full = full.withColumn("sequence_id", key)
    return parts.select(*columns).unionByName(full.select(*columns))
