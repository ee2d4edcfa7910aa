"""Helpers the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.fixtures import TRIPS_SQL, zones_sql

ZONES = zones_sql()
KNOWN_ZONES = zones_sql(20, "zones")  # trips of the last five nations find no zone


def over(body: str, *ctes: str, trips: bool = True) -> str:
    """A SELECT over the trips view and any further named subqueries."""
    parts = ([TRIPS_SQL] if trips else []) + list(ctes)
    return "WITH " + ",".join(parts) + "\n" + body


def days_as_times(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as midnights: engines hand out dates in different client types, times in one."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round for comparison: float sums differ in their last bits by summing order."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in columns})
