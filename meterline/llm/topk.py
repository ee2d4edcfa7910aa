"""Exact top-k by inner product, pruned with multi-resolution segment statistics.

Every vector is cut into segments; a segment is summed up by its mean and deviation. For vectors q and c,
|q - c|^2 >= sum over segments of m * ((mean_q - mean_c)^2 + (dev_q - dev_c)^2), m being the segment's length,
which bounds the inner product from above. Bounds are taken from few wide segments to many narrow ones, each
level only for pairs the level before could not rule out; what survives is computed exactly in integers.

Queries and candidates meet block by block: a block of queries with a group of candidates, each of bounded
size, so that a task holds the same amount at every scale. No pair is emitted; a task returns the best k of
each of its queries, and these partial lists are merged.

Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without an id.
Vectors of different lengths meet only their own length. Ties go to the smaller id; repeated ids are rows of
their own, and a query does not meet rows of its own id. Scores must fit in 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2048
CANDIDATE_GROUP = 8192
LEVELS = (2, 8, 32)  # segments, coarse to fine


def scaled(vector: str, factor: int = 64) -> Column:
    """Components times ``factor``, rounded down; null where the vector takes no part."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(x.isNotNull() & (F.size(x) > 0) & finite, F.transform(x, lambda v: F.floor(v.cast("double") * factor)))


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each row's segments, weighted so that plain inner products bound the true ones."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    weight = np.sqrt([len(p) for p in parts])
    means = np.stack([x[:, p].mean(axis=1) for p in parts], axis=1) * weight
    deviations = np.stack([x[:, p].std(axis=1) for p in parts], axis=1) * weight
    return np.concatenate([means, deviations], axis=1)


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Query position, row position and score of each query's k best rows among these."""
    found = []
    fq, fr = queries.astype(np.float64), rows.astype(np.float64)
    levels = [(segment_statistics(fq, s), segment_statistics(fr, s)) for s in LEVELS if s < rows.shape[1]]
    slack = 1e-6 * (1 + np.abs(fq).sum(1).max(initial=0) * np.abs(fr).max(initial=0))
    for q in range(len(queries)):
        own = ids == query_ids[q]
        bound = levels[0][1] @ levels[0][0][q] if levels else np.full(len(rows), np.inf)
        bound[own] = -np.inf
        alive = np.flatnonzero(~own)
        if len(alive) > k:
            seeds = np.argpartition(bound, -k)[-k:]  # the most promising give the score to beat
            least = (rows[seeds] @ queries[q]).min()
            alive = alive[bound[alive] + slack >= least]
            for stats_q, stats_r in levels[1:]:
                if len(alive) <= k:
                    break
                alive = alive[stats_r[alive] @ stats_q[q] + slack >= least]
        scores = rows[alive] @ queries[q]
        if len(alive) > k:
            limit = np.partition(scores, -k)[-k]
            alive, scores = alive[scores >= limit], scores[scores >= limit]
        rank = np.lexsort((ids[alive], -scores))[:k]
        found += [(q, int(alive[r]), int(scores[r])) for r in rank]
    return found


def top_k(vectors: DataFrame, query_rows: Column, k: int = 20, factor: int = 64) -> DataFrame:
    """``vectors`` (vec_id, embedding); returns query_id, rank, vec_id, score for the rows that ``query_rows`` picks."""
    base = (vectors.select("vec_id", scaled("embedding", factor).alias("x"), F.size("embedding").alias("dims"))
            .where(F.col("x").isNotNull() & F.col("vec_id").isNotNull()))
    sizes = base.agg(F.count("*").alias("n"), F.count_if(query_rows).alias("q")).first()
    blocks, groups = max(1, -(-sizes["q"] // QUERY_BLOCK)), max(1, -(-sizes["n"] // CANDIDATE_GROUP))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("vec_id", F.lit("group")), F.lit(groups)).cast("int")
    queries = base.where(query_rows).select(
        block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "dims", "vec_id", "x")
    candidates = base.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), group.alias("group"), "dims", "vec_id", "x")

    def meet(key, left, right):
        empty = left.num_rows == 0 or right.num_rows == 0
        if empty:
            return pa.table({"query_id": [], "vec_id": [], "score": []}, schema=_FOUND)
        (qi, q), (ci, c) = (_matrix(t) for t in (left, right))
        found = best(q, qi, c, ci, k)
        return pa.table({"query_id": [int(qi[a]) for a, _, _ in found], "vec_id": [int(ci[b]) for _, b, _ in found],
                         "score": [s for _, _, s in found]}, schema=_FOUND)

    keys = ["block", "group", "dims"]
    partial = (queries.groupBy(*keys).cogroup(candidates.groupBy(*keys))
               .applyInArrow(meet, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    x = rows.column("x").combine_chunks()
    return rows.column("vec_id").to_numpy(), x.flatten().to_numpy().reshape(len(x), -1)
