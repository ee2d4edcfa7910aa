"""Two-level ordered computations against plain windows, with one key owning most rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterline.operators import ordered as O
from meterline.operators import windows as W


@pytest.fixture(scope="module")
def hot(spark):
    """Key 1 holds over half of the rows, one value repeats a lot, some keys are null."""
    rnd = random.Random(7)
    data = []
    for i in range(900):
        key = 1 if rnd.random() < 0.5 else rnd.choice([2, 3, 4, None])
        value = 5.0 if rnd.random() < 0.35 else round(rnd.uniform(0, 40), 1)
        data.append((key, value if rnd.random() > 0.05 else None, i))
    return spark.createDataFrame(data, "k int, v double, id int").repartition(5).cache()


def expect(df, window, column, name):
    return sorted(map(tuple, df.select("id", column.over(window).alias(name)).collect()))


def got(df, name):
    return sorted(map(tuple, df.select("id", name).collect()))


@pytest.mark.parametrize("task_rows", [37, 10_000])
def test_row_number(hot, task_rows):
    order = [F.col("v").desc(), F.col("id")]
    out = O.numbered(hot, ["k"], [F.col("v").desc(), "id"], "n", task_rows)
    assert got(out, "n") == expect(hot, Window.partitionBy("k").orderBy(*order), F.row_number(), "n")


@pytest.mark.parametrize("task_rows", [37, 10_000])
def test_ranks(hot, task_rows):
    out = W.all_ranks(hot, ["k"], "v", ["id"], task_rows).cache()
    ties = Window.partitionBy("k").orderBy(F.col("v").desc())
    assert got(out, "rank") == expect(hot, ties, F.rank(), "rank")
    assert got(out, "dense_rank") == expect(hot, ties, F.dense_rank(), "dense_rank")
    full = Window.partitionBy("k").orderBy(F.col("v").desc(), "id")
    assert got(out, "row_number") == expect(hot, full, F.row_number(), "row_number")


@pytest.mark.parametrize("task_rows,offset", [(10, 1), (10, 10), (37, 3), (10_000, 3)])
def test_neighbours(hot, task_rows, offset):
    out = W.prev_next(hot, ["k"], ["v", "id"], "v", offset, task_rows).cache()
    window = Window.partitionBy("k").orderBy("v", "id")
    assert got(out, "prev_v") == expect(hot, window, F.lag("v", offset), "prev_v")
    assert got(out, "next_v") == expect(hot, window, F.lead("v", offset), "next_v")
    assert out.count() == hot.count()


@pytest.mark.parametrize("task_rows", [37, 10_000])
def test_running_and_moving(hot, task_rows):
    window = Window.partitionBy("k").orderBy("v", "id")
    total = W.running_total(hot, ["k"], ["v", "id"], "v", "t", task_rows).withColumn("t", F.round("t", 6))
    plain = hot.withColumn("t", F.round(F.sum("v").over(window.rowsBetween(Window.unboundedPreceding, 0)), 6))
    assert got(total, "t") == got(plain, "t")
    moving = W.moving_avg(hot, ["k"], ["v", "id"], "v", "m", 4, task_rows).withColumn("m", F.round("m", 6))
    plain = hot.withColumn("m", F.round(F.avg("v").over(window.rowsBetween(-4, 0)), 6))
    assert got(moving, "m") == got(plain, "m")


@pytest.mark.parametrize("task_rows,p", [(25, 0.9), (25, 0.0), (10_000, 0.5), (10_000, 1.0)])
def test_percentile(hot, task_rows, p):
    out = O.exact_percentile(hot, ["k"], "v", p, "q", task_rows)
    plain = hot.groupBy("k").agg(F.percentile("v", p).alias("q"))
    near = lambda df: sorted((repr(k), round(q, 9)) for k, q in map(tuple, df.select("k", "q").collect()))
    assert near(out) == near(plain)


def test_percentile_on_every_row_keeps_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (7, None), (8, 2.0)], "k int, v double")
    out = W.percentile_in_group(df, ["k"], "v", 0.5, "q")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(None, 1.0, 2.0), (None, 3.0, 2.0), (7, None, None), (8, 2.0, 2.0)], key=repr)


def test_whole_table_as_one_group(hot):
    out = O.numbered(hot, [], ["v", "id"], "n", 10)
    assert sorted(r.n for r in out.select("n").collect()) == list(range(1, 901))


def test_copies_are_spread_and_kept(spark):
    """Rows equal in every column still get one place each."""
    df = spark.range(0, 600, 1, 6).select(F.lit(1).alias("k"), F.lit(2.0).alias("v"))
    out = O.numbered(df, ["k"], ["v"], "n", 50)
    assert sorted(r.n for r in out.select("n").collect()) == list(range(1, 601))


def test_dedup_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    out = W.dedup(df, ["k"], [F.col("id").desc()])
    assert sorted(map(tuple, out.collect())) == [(0, 99), (1, 97), (2, 98)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_nth_largest_with_ties(spark):
    df = spark.createDataFrame([(1, 9.0), (2, 9.0), (3, 7.0), (4, 5.0), (5, None)], "id int, v double")
    assert W.nth_largest(df, "v", 2).collect() == []
    assert [tuple(r) for r in W.nth_largest(df, "v", 3).select("id", "v", "rank").collect()] == [(3, 7.0, 3)]
    assert sorted(r.id for r in W.nth_largest(df, "v", 1).collect()) == [1, 2]


def test_ranks_shuffle_the_rows_once_after_numbering(hot):
    out = W.all_ranks(hot, ["k"], "v", ["id"], 37)
    plan = out._jdf.queryExecution().executedPlan().toString()
    rows_side = plan.split("BroadcastExchange")[0]
    assert rows_side.count("Exchange hashpartitioning") == 1


def test_frame_wider_than_a_block(hot):
    out = W.moving_avg(hot, ["k"], ["v", "id"], "v", "m", 50, 10).withColumn("m", F.round("m", 6))
    window = Window.partitionBy("k").orderBy("v", "id").rowsBetween(-50, 0)
    plain = hot.withColumn("m", F.round(F.avg("v").over(window), 6))
    assert out.select("k", "v", "id", "m").exceptAll(plain.select("k", "v", "id", "m")).count() == 0
