"""Embedding near-dedup with an epsilon grid order join.

Unit vectors at cosine c are at distance sqrt(2 - 2c) =: epsilon. Vectors are turned to principal dimensions
and sorted by their grid cells of width epsilon on the leading ones. The sequence is cut into intervals of
bounded size, and pairs of interval groups are refined from the whole sequence down, leaving out pairs whose
bounding boxes are more than epsilon apart. A task joins two intervals, halving them again and skipping
provably distant halves before it multiplies blocks in double precision. It returns the number of links and
one spanning link per vector, never pairs.

Equal vectors are one class from the start, with their number as weight. Vectors that are null, empty, zero or
hold null or non-finite components, and rows without id, link with nothing and stay alone. Vectors meet only
vectors of their own length. Repeated ids are rows of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.components import components
from meterline.llm.storage import stored

LEADING = 6  # principal dimensions with grid cells and bounding boxes
INTERVAL = 4096  # vectors of a sequence interval
FAN = 16  # intervals of a group, groups of a larger group
BLOCK = 256  # vectors below which intervals aren't halved
SLACK = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes of doubles, with a digest that equal vectors share."""
    for batch in batches:
        ids, digests, values = [], [], []
        for vec_id, vector in zip(batch.column(0), batch.column(1)):
            if not vector.is_valid or not vec_id.is_valid or vector.values.null_count or not len(vector.values):
                continue
            x = vector.values.to_numpy().astype(np.float64)
            if np.isfinite(x).all() and x.any():
                ids.append(vec_id.as_py())
                values.append(x.tobytes())
                digests.append(hashlib.md5(values[-1]).digest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(values, pa.binary())],
                                         names=["vec_id", "digest", "x"])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products of unit vectors, a row per dimension count and matrix row."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for d, x in _by_length(batch.column(0).to_pylist()):
            sums[d] = sums.get(d, 0) + _unit(x).T @ _unit(x)
    for d, total in sums.items():
        k = np.arange(d * d)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d)), pa.array(k), pa.array(total.ravel())], names=["d", "k", "v"])


def _by_length(raw: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    for size in sorted({len(b) for b in raw}):
        yield size // 8, np.frombuffer(b"".join(b for b in raw if len(b) == size)).reshape(-1, size // 8)


def principal(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal directions of the unit vectors, by dimension count; all rows count."""
    rows = (vectors.select("x").mapInArrow(_moments, "d long, k long, v double")
            .groupBy("d", "k").agg(F.sum("v").alias("v")).collect())  # d * d rows for each dimension count d
    out = {}
    for d in {r["d"] for r in rows}:
        m = np.zeros(d * d)
        for r in rows:
            if r["d"] == d:
                m[r["k"]] = r["v"]
        _, axes = np.linalg.eigh(m.reshape(d, d))
        out[d] = axes[:, ::-1][:, :LEADING]
    return out


def _box(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    y = x @ axes
    return np.pad(y, ((0, 0), (0, LEADING - y.shape[1])))


def _cells(epsilon: float, axes: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(batch.schema.get_field_index("x")).to_pylist()
            cells = [np.floor(_box(_unit(np.frombuffer(b)[None, :]), axes[len(b) // 8])[0] / epsilon).astype(int).tolist() for b in raw]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(b) // 8 for b in raw], pa.int64()),
                                              *(pa.array([c[k] for c in cells], pa.int64()) for k in range(LEADING))],
                                             names=[*batch.schema.names, "d", *(f"c{k}" for k in range(LEADING))])
    return run


def _intervals(axes: dict[int, np.ndarray]):
    names = [f"{side}{k}" for side in ("low", "high") for k in range(LEADING)]

    def run(key, rows):
        rows = rows.sort_by("rank")
        x = np.frombuffer(b"".join(rows.column("x").to_pylist())).reshape(rows.num_rows, -1)
        y = _box(_unit(x), axes[x.shape[1]])
        box = [*y.min(axis=0), *y.max(axis=0)]
        return pa.table({"node": [key[0].as_py()], "d": [x.shape[1]], "ids": [rows.column("id").to_numpy().tobytes()],
                         "weights": [rows.column("weight").to_numpy().tobytes()], "xs": [x.tobytes()],
                         **{c: [float(v)] for c, v in zip(names, box)}})
    return run, "node long, d long, ids binary, weights binary, xs binary, " + ", ".join(f"{c} double" for c in names)


def _apart(a: np.ndarray, b: np.ndarray) -> float:
    """Squared distance of the bounding boxes of two blocks of leading coordinates."""
    gap = np.maximum(np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)), 0)
    return float(gap @ gap)


def _blocks(ya, yb, a, b, same, epsilon, out) -> None:
    """Pairs of blocks left after halving both intervals while their halves may be near."""
    if _apart(ya[a[0]:a[1]], yb[b[0]:b[1]]) > epsilon ** 2 + SLACK or (same and a[0] >= b[1]):
        return
    na, nb = a[1] - a[0], b[1] - b[0]
    if na <= BLOCK and nb <= BLOCK:
        out.append((a, b))
        return
    halves = lambda s: [(s[0], (s[0] + s[1]) // 2), ((s[0] + s[1]) // 2, s[1])] if s[1] - s[0] > BLOCK else [s]
    for p in halves(a):
        for q in halves(b):
            _blocks(ya, yb, p, q, same, epsilon, out)


def _joined(least: float, epsilon: float, axes: dict[int, np.ndarray]):
    def run(key, left, right):
        empty = pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty
        same = key[0].as_py() == key[1].as_py()
        (ia, wa, xa), (ib, wb, xb) = (
            (np.frombuffer(t.column("ids")[0].as_py(), np.int64), np.frombuffer(t.column("weights")[0].as_py(), np.int64),
             np.frombuffer(t.column("xs")[0].as_py()).reshape(-1, t.column("d")[0].as_py())) for t in (left, right))
        if xa.shape[1] != xb.shape[1]:
            return empty
        xa, xb = _unit(xa), _unit(xb)
        ya, yb = _box(xa, axes[xa.shape[1]]), _box(xb, axes[xb.shape[1]])
        todo: list = []
        _blocks(ya, yb, (0, len(ia)), (0, len(ib)), same, epsilon, todo)
        shift = 0 if same else len(ia)
        root = np.arange(len(ia) + (0 if same else len(ib)))
        links = np.zeros(len(root), np.int64)
        for (a0, a1), (b0, b1) in todo:
            near = xa[a0:a1] @ xb[b0:b1].T >= least
            if same:
                near &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)[None, :]
            if not near.any():
                continue
            links[a0:a1] += near @ wb[b0:b1]
            links[shift + b0:shift + b1] += near.T @ wa[a0:a1]
            p, q = np.nonzero(near)
            _unite(root, p + a0, q + b0 + shift)
        linked = np.flatnonzero(links)
        ids = ia if same else np.concatenate([ia, ib])
        return pa.table({"id": ids[linked], "links": links[linked], "root": ids[root[linked]]})
    return run


def _unite(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    while True:
        a, b = root[p], root[q]
        differ = a != b
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _near_pairs(intervals: DataFrame, count: int, epsilon: float) -> DataFrame:
    """Pairs (a, b), a <= b, of intervals whose boxes may hold linked vectors, refined from the whole sequence down."""
    sides = [f"low{k}" for k in range(LEADING)], [f"high{k}" for k in range(LEADING)]
    levels = [intervals.select("node", *sides[0], *sides[1])]
    size = count
    while size > 1:
        levels.append(levels[-1].groupBy(F.floor(F.col("node") / FAN).alias("node")).agg(
            *(F.min(c).alias(c) for c in sides[0]), *(F.max(c).alias(c) for c in sides[1])))
        size = -(-size // FAN)
    pairs = intervals.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    parts = F.sequence(F.lit(0), F.lit(FAN - 1))
    for boxes in reversed(levels[:-1] if len(levels) > 1 else []):
        pairs = (pairs.withColumn("i", F.explode(parts)).withColumn("j", F.explode(parts))
                 .select((F.col("a") * FAN + F.col("i")).alias("a"), (F.col("b") * FAN + F.col("j")).alias("b")).where("a <= b"))
        for side in ("a", "b"):
            named = boxes.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in sides[0] + sides[1]))
            pairs = pairs.join(named, side)
        gaps = [F.greatest(F.col(f"a_low{k}") - F.col(f"b_high{k}"), F.col(f"b_low{k}") - F.col(f"a_high{k}"), F.lit(0.0))
                for k in range(LEADING)]
        pairs = pairs.where(sum((g * g for g in gaps), F.lit(0.0)) <= epsilon ** 2 + SLACK).select("a", "b")
    return pairs


def near_vectors(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding)."""
    epsilon = math.sqrt(max(0.0, 2 - 2 * least)) + SLACK
    prepared = stored(vectors.select("vec_id", "embedding").mapInArrow(_prepared, "vec_id long, digest binary, x binary"), "vectors")
    classes = prepared.groupBy("digest").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("x").alias("x"))
    axes = principal(prepared)
    cells = ", ".join(f"c{k} long" for k in range(LEADING))
    order = ["d", *(f"c{k}" for k in range(LEADING)), "digest"]
    grid = classes.mapInArrow(_cells(epsilon, axes), f"digest binary, id long, weight long, x binary, d long, {cells}")
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sequence = stored(grid.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
                      .withColumn("place", F.monotonically_increasing_id()), "grid-order")
    counts = {(r["part"], r["d"]): r["n"] for r in sequence.groupBy(F.shiftright("place", 33).alias("part"), "d")
              .agg(F.count("*").alias("n")).collect()}  # a row per partition of the sort
    offsets, at, last = [], 0, None
    begun: dict[int, int] = {}
    for (part, d), n in sorted(counts.items(), key=lambda x: (x[0][0], x[0][1])):
        if d != last and last is not None:
            at = -(-at // INTERVAL) * INTERVAL  # an interval holds vectors of one length
        last = d
        inside = begun.get(part, 0)
        offsets.append((part, d, at - inside))
        begun[part] = inside + n
        at += n
    count = -(-at // INTERVAL)
    starts = vectors.sparkSession.createDataFrame(offsets, "part long, d long, shift long")
    rank = F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("shift")
    ranked = (sequence.withColumn("part", F.shiftright("place", 33)).join(F.broadcast(starts), ["part", "d"])
              .select(F.col("place").alias("id"), "weight", "x", rank.alias("rank"), F.floor(rank / INTERVAL).alias("node")))
    cut, kinds = _intervals(axes)
    intervals = stored(ranked.groupBy("node").applyInArrow(cut, kinds), "intervals")
    pairs = stored(_near_pairs(intervals, count, epsilon), "interval-pairs")
    blobs = intervals.select("node", "d", "ids", "weights", "xs")
    sides = []
    for side in ("a", "b"):
        met = pairs.join(blobs.withColumnRenamed("node", side), side)
        fresh = met.select(*(F.col(c).alias(c) for c in met.columns))  # own column identities on either side
        sides.append(fresh.groupBy("a", "b"))
    found = stored(sides[0].cogroup(sides[1]).applyInArrow(_joined(least, epsilon, axes), "id long, links long, root long"), "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    grouped = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    # a class is named by its place in the sequence, since one id may have several vectors
    named = sequence.select("digest", "weight", F.col("id").alias("least"), F.col("place").alias("id"))
    whole = (named.join(links, "id", "left").join(grouped, "id", "left")
             .withColumn("component", F.coalesce("component", "id")))
    least_of = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = whole.join(least_of, "component").select(
        "digest", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    known = stored(prepared.select("vec_id", "digest").join(labelled, "digest").select("vec_id", "n_links", "component_id"), "known")
    rest = _rest(vectors)
    out = known.unionByName(rest)
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _rest(vectors: DataFrame) -> DataFrame:
    """Rows whose vectors take no part."""
    x = F.col("embedding")
    usable = (F.col("vec_id").isNotNull() & x.isNotNull() & F.exists(x, lambda v: v != 0)
              & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    return (vectors.where(~F.coalesce(usable, F.lit(False)))
            .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
