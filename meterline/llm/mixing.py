"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of the digest of their id, form blocks of equal size. A source of
weight w may place its j-th block (from 1) no earlier than slot floor((j - 1) / w) and must place it before
slot ceil(j / w); earliest deadline first among the released blocks keeps every source less than one block
from its target at every slot, as long as no source has run out. Weights are shares of a period, so the schedule
of one period, whose length only depends on the number of sources, serves the whole input. When a source has
run out its slots stay empty and the others keep their proportions; no document is dropped or repeated.

Null is a source of its own, apart from the empty name. Null ids share one digest and come first. Repeated rows
are placed as often as they occur; which of two equal rows comes first is left open. An empty table gives no
rows. Further columns travel along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS_A_SOURCE = 64  # slots of a period are this times the number of sources: weights are kept to that precision
BUCKET_ROWS = 4096
BUCKETS = 65536  # at most; the digests of a source are numbered bucket by bucket


def shares(counts: DataFrame, weight: Column) -> DataFrame:
    """key, i, share, period: whole slots of each source in a period, by largest remainder, one at least.

    ``counts`` has a row per source, as do all windows here.
    """
    every = Window.partitionBy()
    exact = F.col("w") / F.sum("w").over(every) * SLOTS_A_SOURCE * F.count("*").over(every)
    scaled = (counts.withColumn("w", weight.cast("double")).withColumn("exact", exact)
              .withColumn("low", F.floor("exact")))
    left = SLOTS_A_SOURCE * F.count("*").over(every) - F.sum("low").over(every)
    by_rest = Window.orderBy(F.desc(F.col("exact") - F.col("low")), "key")
    share = F.greatest(F.lit(1), F.col("low") + F.when(F.col("turn") <= F.col("left"), 1).otherwise(0)).cast("int")
    return (scaled.withColumns({"turn": F.row_number().over(by_rest), "left": left}).withColumn("share", share)
            .select("key", (F.row_number().over(Window.orderBy("key")) - 1).alias("i"), "share",
                    F.sum("share").over(every).cast("int").alias("period")))


def schedule(parts: DataFrame) -> DataFrame:
    """key, share, period, nth, slot: which source's nth block of a period takes which slot of it."""
    one = parts.agg(F.array_sort(F.collect_list(F.struct("i", "share", "key"))).alias("s"), F.max("period").alias("p"))

    def step(state: Column, t: Column) -> Column:
        def candidate(i: Column) -> Column:
            done, share = F.get(state["done"], i), F.get(F.col("s"), i)["share"]
            release = F.floor(done * F.col("p") / share)
            deadline = F.ceil((done + 1) * F.col("p") / share)
            return F.when((release <= t) & (done < share), F.struct(deadline.alias("deadline"), i.alias("i"), done.alias("nth")))
        ready = F.array_min(F.array_compact(F.transform(F.sequence(F.lit(0), F.size("s") - 1), candidate)))
        return F.struct(
            F.transform(state["done"], lambda d, i: F.when(i == ready["i"], d + 1).otherwise(d)).alias("done"),
            F.array_append(state["slots"], F.struct(t.alias("slot"), ready["i"].alias("i"), ready["nth"].alias("nth"))).alias("slots"))
    start = F.struct(F.transform("s", lambda _: F.lit(0)).alias("done"),
                     F.expr("cast(array() as array<struct<slot:int,i:int,nth:int>>)").alias("slots"))
    folded = one.where(F.size("s") > 0).select("s", "p", F.aggregate(F.sequence(F.lit(0), F.col("p") - 1), start, step).alias("r"))
    return (folded.select("s", "p", F.explode("r.slots").alias("x"))
            .select(F.get("s", F.col("x.i"))["key"].alias("key"), F.get("s", F.col("x.i"))["share"].alias("share"),
                    F.col("p").alias("period"), F.col("x.nth").alias("nth"), F.col("x.slot").alias("slot")))


def interleave(docs: DataFrame, block: int = 64, weight: Column | None = None,
               added: tuple[str, str, str] = ("block", "slot", "place")) -> DataFrame:
    """The documents with their block, its slot, and their place in the block: reading by slot and place gives the mix.

    ``weight`` is an expression of ``key`` (the source after an "s", or "n" for null) and ``n``, its number of
    documents; by default the square root of n, which lifts small sources. ``added`` names the new columns; an
    input column of such a name is replaced.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in added)).alias("row"), "doc_id",
        F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source"))).alias("key"),
        F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")).alias("digest"))
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    buckets = min(BUCKETS, max(1, -(-docs.count() // BUCKET_ROWS)))
    head = F.coalesce(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(0))
    rows = rows.withColumn("bucket", F.shiftright(head * buckets, 32).cast("int"))
    before = (rows.groupBy("key", "bucket").agg(F.count("*").alias("rows"))
              .withColumn("before", F.sum("rows").over(Window.partitionBy("key").orderBy("bucket")) - F.col("rows"))
              .drop("rows"))
    inside = Window.partitionBy("key", "bucket").orderBy("digest", "doc_id")
    ranked = rows.withColumn("turn", F.row_number().over(inside)).join(before, ["key", "bucket"])
    rank = F.col("before") + F.col("turn") - 1
    plan = schedule(shares(counts, F.sqrt("n") if weight is None else weight))
    # both tables have at most a period's rows
    placed = (ranked.withColumn("block", F.floor(rank / block)).withColumn("place", (rank % block).cast("int"))
              .join(F.broadcast(plan.select("key", "share").distinct()), "key")
              .withColumn("nth", (F.col("block") % F.col("share")).cast("int"))
              .join(F.broadcast(plan.select("key", "nth", "period", F.col("slot").alias("at"))), ["key", "nth"]))
    slot = F.floor(F.col("block") / F.col("share")) * F.col("period") + F.col("at")
    return placed.select("row.*", F.col("block").alias(added[0]), slot.alias(added[1]), F.col("place").alias(added[2]))


MIX_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key,
    coalesce(md5(doc_id::VARCHAR), '') AS digest FROM documents),
c AS (SELECT key, sqrt(count(*)) AS w FROM d GROUP BY key),
e AS (SELECT key, w / sum(w) OVER () * {SLOTS_A_SOURCE} * count(*) OVER () AS exact FROM c),
f AS (SELECT key, exact, floor(exact) AS low, row_number() OVER (ORDER BY exact - floor(exact) DESC, key) AS turn,
  {SLOTS_A_SOURCE} * count(*) OVER () - sum(floor(exact)) OVER () AS rest FROM e),
g AS (SELECT key, greatest(1, low + CASE WHEN turn <= rest THEN 1 ELSE 0 END)::INTEGER AS share FROM f),
s AS (SELECT list(share ORDER BY key) AS shares, list(key ORDER BY key) AS keys, sum(share)::INTEGER AS period FROM g),
plan AS (
  SELECT -1 AS slot, list_transform(shares, lambda x: 0) AS done, NULL::INTEGER AS i, NULL::INTEGER AS nth FROM s
  UNION ALL
  SELECT slot + 1, list_transform(done, lambda x, k: CASE WHEN k = pick THEN x + 1 ELSE x END), pick, done[pick]
  FROM (
    SELECT slot, done, list_min(list_filter(list_transform(range(1, len(shares) + 1), lambda k:
      CASE WHEN floor(done[k] * period::DOUBLE / shares[k]) <= slot + 1 AND done[k] < shares[k]
      THEN ceil((done[k] + 1) * period::DOUBLE / shares[k])::BIGINT * 1000000 + k END), lambda v: v IS NOT NULL)) % 1000000 AS pick, period
    FROM plan, s WHERE slot + 1 < period)),
named AS (SELECT keys[i] AS key, shares[i] AS share, period, nth, slot FROM plan, s WHERE i IS NOT NULL),
r AS (SELECT doc_id, source, key, row_number() OVER (PARTITION BY key ORDER BY digest, doc_id) - 1 AS rank FROM d),
b AS (SELECT r.*, rank // {{block}} AS block, rank % {{block}} AS place, g.share FROM r JOIN g USING (key))
SELECT b.doc_id, b.source, b.block::BIGINT AS block, (b.block // b.share * n.period + n.slot)::BIGINT AS slot, b.place::INTEGER AS place
FROM b JOIN named n ON n.key = b.key AND n.nth = b.block % b.share"""
