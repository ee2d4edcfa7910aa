"""Joins of a fact to lookups. Spark decides from byte sizes, at run time, which side to broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; keeps the left keys once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def lookup_join(fact: DataFrame, lookup: DataFrame, key: str | Column, lookup_key: str,
                columns: dict[str, str], how: str = "left") -> DataFrame:
    """Add lookup columns to a fact under new names (``{lookup column: new name}``).

    The same lookup can be joined again under another role. ``key`` may be an
    expression; it is cast to the lookup key's type, so text ids meet numeric ones and
    text that is no id meets nothing.
    """
    side = lookup.select(F.col(lookup_key).alias("_key"), *[F.col(c).alias(n) for c, n in columns.items()])
    on = F.col(key) if isinstance(key, str) else key
    on = on.try_cast(lookup.schema[lookup_key].dataType)
    return fact.join(side, on == F.col("_key"), how).drop("_key")


def outer_on_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with the key columns merged. Null keys stay apart."""
    return left.join(right, on=keys, how="outer")


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key is absent from the parent."""
    known = parent.select(F.col(field).alias("_field")).filter(F.col("_field").isNotNull()).distinct()
    return (child.filter(F.col(column).isNotNull())
            .join(known, F.col(column) == F.col("_field"), "left_anti"))
