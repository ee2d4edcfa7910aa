"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import forget, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id of a link; the component is the smallest id reachable.

    Alternating star rounds: each id points to the smallest id it knows, then larger neighbours are hung
    below that id. The number of links never grows, a hub's links are aggregated map-side, and rounds are
    written to the shared folder, so they number about the logarithm of the longest chain.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "links")
    state = None
    while True:
        # large star: larger neighbours of u are linked with the smallest id around u
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: u and its smaller neighbours are linked with the smallest of them
        large = stored(large.where("u > v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                           F.col("m").alias("v"))
        fresh = stored(hung.where("u > v").distinct(), "small-star")
        seen = fresh.agg(F.count("*"), F.sum("v"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                         F.count_distinct("u")).first()
        forget(edges)
        forget(large)
        edges = fresh
        if tuple(seen) == state or seen[0] == 0:
            break
        state = tuple(seen)
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
