"""Ordered computations per key that also hold when one key owns most rows.

A plain window sends all rows of a key to one task. Here the answers come in two
levels, the same way for every size:

1. ``numbered`` lays the rows out by range over (keys, order), so a large key
   spreads over many partitions, writes that layout to the shared folder and
   turns the place inside a partition into the place inside the key.
2. Rows then fall into equal blocks of ``task_rows`` places, or of the frame's
   width if that is more. Frames see the rows they need of the next block
   (``framed``); running totals add the sum of all earlier blocks (``running``).

Neither level puts an unbounded group into one task, and no row is dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.operators.joins import null_safe_join
from meterline.session import stored

TASK_ROWS = 1_000_000
_SLICE_BITS = 33  # monotonically_increasing_id keeps the row's place in the low 33 bits


def _order_columns(order: list[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _window(keys: list[str], order: list[Column]) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def _numbered_by_range(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    laid_out = stored(
        # The partition id splits rows that agree in every ordering column.
        df.withColumn("_split", F.spark_partition_id())
        .repartitionByRange(*[F.col(k) for k in keys], *order, F.col("_split"))
        .sortWithinPartitions(*[F.col(k) for k in keys], *order)
        .drop("_split")
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_id", _SLICE_BITS))
        .withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1)))
        .drop("_id"),
        "ordered",
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # The layout's index, a row per slice and key in it. As a table its size in bytes is known to the planner.
    starts = stored(
        laid_out.groupBy("_slice", *keys)
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
        .select("_slice", *keys,
                (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift")),
        "ordered-index",
    )
    return (
        null_safe_join(laid_out, starts, ["_slice", *keys])
        .withColumn(name, F.col("_at") + F.col("_shift"))
        .drop("_slice", "_at", "_shift")
    )


def numbered(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "row_number",
             task_rows: int = TASK_ROWS) -> DataFrame:
    """Row number within the keys. ``order`` should tell any two unlike rows apart."""
    return _numbered_by_range(df, keys, _order_columns(order), name)


def _blocks(df: DataFrame, place: str, task_rows: int) -> DataFrame:
    return df.withColumn("_block", F.floor((F.col(place) - 1) / F.lit(task_rows)))


def _framed_blocks(df: DataFrame, keys: list[str], place: str,
                   columns: dict[str, Callable[[Window], Column]],
                   before: int, after: int, task_rows: int) -> DataFrame:
    task_rows = max(task_rows, before, after)
    inside = (F.col(place) - 1) % F.lit(task_rows)
    homes = F.array_compact(F.array(
        F.col("_block"),
        F.when(inside < after, F.col("_block") - 1),
        F.when(inside >= task_rows - before, F.col("_block") + 1),
    ))
    window = _window([*keys, "_home"], [F.col(place)])
    return (
        _blocks(df, place, task_rows)
        .withColumn("_home", F.explode(homes))
        .withColumns({name: make(window) for name, make in columns.items()})
        .filter(F.col("_home") == F.col("_block"))
        # The rows are clustered and sorted by _home; under this name a running
        # total over the same blocks finds them in place and shuffles nothing.
        .drop("_block").withColumnRenamed("_home", "_block")
    )


def framed(df: DataFrame, keys: list[str], order: list[str | Column],
           columns: dict[str, Callable[[Window], Column]], before: int, after: int,
           task_rows: int = TASK_ROWS) -> DataFrame:
    """Window columns that look at most ``before`` rows back and ``after`` rows ahead."""
    placed = _numbered_by_range(df, keys, _order_columns(order), "_place")
    return _framed_blocks(placed, keys, "_place", columns, before, after, task_rows).drop("_place", "_block")


def _running_blocks(df: DataFrame, keys: list[str], place: str, totals: dict[str, tuple[str, Column]],
                    task_rows: int) -> DataFrame:
    fold = {"sum": F.sum, "max": F.max}
    blocked = df if "_block" in df.columns else _blocks(df, place, task_rows)
    inner = _window([*keys, "_block"], [F.col(place)]).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.groupBy(*keys, "_block")
        .agg(*[fold[how](value).alias(f"_all_{name}") for name, (how, value) in totals.items()])
        .select(*keys, "_block", *[fold[how](f"_all_{name}").over(earlier).alias(f"_carry_{name}")
                                   for name, (how, _) in totals.items()])
    )
    inside = blocked.withColumns({name: fold[how](value).over(inner) for name, (how, value) in totals.items()})
    joined = null_safe_join(inside, carried, [*keys, "_block"])

    def finish(name: str, how: str) -> Column:
        here, carry = F.col(name), F.col(f"_carry_{name}")
        if how == "max":
            return F.greatest(here, carry)
        return F.when(carry.isNull(), here).when(here.isNull(), carry).otherwise(here + carry)

    return (joined.withColumns({name: finish(name, how) for name, (how, _) in totals.items()})
            .drop("_block", *[f"_carry_{name}" for name in totals]))


def running(df: DataFrame, keys: list[str], order: list[str | Column],
            totals: dict[str, Column], task_rows: int = TASK_ROWS) -> DataFrame:
    """Running sums from the first row of the key to the current row."""
    placed = _numbered_by_range(df, keys, _order_columns(order), "_place")
    sums = {name: ("sum", value) for name, value in totals.items()}
    return _running_blocks(placed, keys, "_place", sums, task_rows).drop("_place")


def runs(df: DataFrame, keys: list[str], order: list[str | Column], opens: Callable[[Window], Column], name: str = "run",
         task_rows: int = TASK_ROWS) -> DataFrame:
    """Number the runs of each key: a row for which ``opens`` holds begins one. It may look one row back."""
    placed = _numbered_by_range(df, keys, _order_columns(order), "_place")
    marked = _framed_blocks(placed, keys, "_place", {"_opens": lambda w: opens(w).cast("bigint")}, before=1, after=0,
                            task_rows=task_rows)
    return _running_blocks(marked, keys, "_place", {name: ("sum", F.col("_opens"))}, task_rows).drop("_place", "_opens")


def ranked(df: DataFrame, keys: list[str], value: str, descending: bool, tie_break: list[str],
           task_rows: int = TASK_ROWS) -> DataFrame:
    """``row_number``, ``rank`` and ``dense_rank`` of a value within the keys."""
    by_value = F.col(value).desc() if descending else F.col(value).asc()
    full = [by_value, *_order_columns(tie_break)]
    placed = _numbered_by_range(df, keys, full, "row_number")
    marked = _framed_blocks(
        placed, keys, "row_number",
        {"_starts": lambda w: (F.lag(F.lit(True)).over(w).isNull()
                               | ~F.col(value).eqNullSafe(F.lag(value).over(w)))},
        before=1, after=0, task_rows=task_rows)
    totals = {
        "rank": ("max", F.when(F.col("_starts"), F.col("row_number"))),
        "dense_rank": ("sum", F.col("_starts").cast("bigint")),
    }
    return _running_blocks(marked, keys, "row_number", totals, task_rows).drop("_starts")


def exact_percentile(df: DataFrame, keys: list[str], value: str, p: float, name: str,
                     task_rows: int = TASK_ROWS) -> DataFrame:
    """Continuous percentile per key, one row per key; nulls are ignored.

    Equal values collapse to one counted row before anything is ordered, so the
    work after the first shuffle grows with the distinct values only.
    """
    if not keys:
        raise ValueError("a percentile needs at least one key column")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    placed = _numbered_by_range(counts, keys, [F.col(value)], "_place")  # the one step that is stored
    upto = _running_blocks(placed, keys, "_place", {"_upto": ("sum", F.col("_n"))}, task_rows).drop("_place")
    sizes = placed.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    spot = F.lit(p) * (F.col("_size") - 1)
    holds = lambda place: (F.col("_upto") - F.col("_n") <= place) & (place < F.col("_upto"))
    low, high = F.floor(spot), F.ceil(spot)
    return (
        null_safe_join(upto, sizes, keys)
        .filter(holds(low) | holds(high))
        .groupBy(*keys)
        .agg(F.max(F.when(holds(low), F.col(value))).alias("_low"),
             F.max(F.when(holds(high), F.col(value))).alias("_high"),
             F.max(spot - low).alias("_part"))
        .select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias(name))
    )
