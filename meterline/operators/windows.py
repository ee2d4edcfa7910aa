"""Ranking, neighbour, running and percentile columns over trip-like rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.operators import ordered
from meterline.operators.aggregates import top_k
from meterline.operators.joins import null_safe_join
from meterline.operators.ordered import TASK_ROWS


def top_amounts(df: DataFrame, value: str, tie_break: list[str], k: int, name: str = "ranking") -> DataFrame:
    """The k largest rows with their place. Only those k rows meet in one task."""
    order = [F.col(value).desc(), *[F.col(c) for c in tie_break]]
    return top_k(df, order, k).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def rank_in_group(df: DataFrame, keys: list[str], value: str, tie_break: list[str],
                  name: str = "ranking", task_rows: int = TASK_ROWS) -> DataFrame:
    return ordered.numbered(df, keys, [F.col(value).desc(), *tie_break], name, task_rows)


def all_ranks(df: DataFrame, keys: list[str], value: str, tie_break: list[str],
              task_rows: int = TASK_ROWS) -> DataFrame:
    return ordered.ranked(df, keys, value, True, tie_break, task_rows)


def prev_next(df: DataFrame, keys: list[str], order: list[str], value: str, offset: int = 1,
              task_rows: int = TASK_ROWS) -> DataFrame:
    """The value ``offset`` rows before and after, as ``prev_`` and ``next_`` columns."""
    return ordered.framed(df, keys, order, {
        f"prev_{value}": lambda w: F.lag(value, offset).over(w),
        f"next_{value}": lambda w: F.lead(value, offset).over(w),
    }, before=offset, after=offset, task_rows=task_rows)


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, name: str,
                  task_rows: int = TASK_ROWS) -> DataFrame:
    return ordered.running(df, keys, order, {name: F.col(value)}, task_rows)


def moving_avg(df: DataFrame, keys: list[str], order: list[str], value: str, name: str,
               rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """Average of the current row and the ``rows`` rows before it."""
    return ordered.framed(df, keys, order,
                          {name: lambda w: F.avg(value).over(w.rowsBetween(-rows, 0))},
                          before=rows, after=0, task_rows=task_rows)


def percentile_in_group(df: DataFrame, keys: list[str], value: str, p: float, name: str,
                        task_rows: int = TASK_ROWS) -> DataFrame:
    """Every row with the exact percentile of its group."""
    groups = ordered.exact_percentile(df, keys, value, p, name, task_rows)
    return null_safe_join(df, groups, keys, "left")


def dedup(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Keep the first row of each key.

    ``row_number() = 1`` lets every task drop all but one row per key before the
    shuffle, so a heavily copied key shrinks where it is read.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(first)).filter("_row = 1").drop("_row")


def nth_largest(df: DataFrame, value: str, n: int, name: str = "rank") -> DataFrame:
    """Rows whose RANK by a value, largest first, is exactly ``n``.

    Values are ranked once per distinct value, from the n largest distinct ones;
    ties above may skip rank ``n``, and then there is no such row.
    """
    largest = top_k(df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n")),
                    [F.col(value).desc()], n)
    above = Window.orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    hit = (largest.withColumn(name, F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1)
           .filter(F.col(name) == n).select(value, name))
    return df.join(F.broadcast(hit), value)
