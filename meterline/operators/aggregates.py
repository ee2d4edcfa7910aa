"""Grouped measures. All of them aggregate map-side before any shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First k rows of an order, kept per task before the final merge."""
    return df.orderBy(*order).limit(k)


def most_frequent(df: DataFrame, keys: list[str], k: int, name: str = "n", least: bool = False) -> DataFrame:
    """The k most (or least) frequent key values; equal counts go by key."""
    count = F.col(name).asc() if least else F.col(name).desc()
    return top_k(count_by(df, *keys, name=name), [count, *[F.col(c).asc_nulls_last() for c in keys]], k)


def _all_present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def duplicate_report(df: DataFrame, required: list[str], optional: list[str] = ()) -> DataFrame:
    """Rows, distinct keys and the difference, in one row.

    The key is a struct, not joined text. A row lacking a ``required`` part has
    no key and so counts as a duplicate; a missing ``optional`` part is a value.
    """
    key = F.when(_all_present(list(required)), F.struct(*required, *optional))
    return df.agg(F.count("*").alias("total_rows"), F.countDistinct(key).alias("distinct_rows")).withColumn(
        "duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def distinct_pairs(df: DataFrame, first: str, second: str, name: str) -> DataFrame:
    """Distinct value pairs among the rows where both are present."""
    return df.agg(F.countDistinct(first, second).alias(name))


def share_of_total(counts: DataFrame, count: str, name: str = "share") -> DataFrame:
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(name, F.col(count).cast("double") / total)


def count_over_threshold(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """All rows and the rows above a threshold, in one pass; missing and NaN are not above."""
    return df.agg(F.count("*").alias("total_rows"),
                  F.count_if((F.col(column) > F.lit(threshold)) & ~F.isnan(F.col(column).cast("double"))).alias("rows_over"))


def span(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first_value"), F.max(column).alias("last_value"),
                  F.count("*").alias("n"))
