"""From raw records to typed events with event time. Works on batches and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import scalars as X


def parse_events(df: DataFrame, schema: str, on_error: str = "skip", column: str = "value") -> DataFrame:
    """Fields of JSON records.

    ``skip`` drops records that are not JSON and nulls single fields that do not
    fit; ``fail`` stops at the first bad record.
    """
    if on_error == "fail":
        options = {"mode": "FAILFAST", "allowNonNumericNumbers": "false"}
        return df.select(F.from_json(column, schema, options).alias("_event")).select("_event.*")
    if on_error != "skip":
        raise ValueError("on_error is 'skip' or 'fail'")
    parsed = F.from_json(column, f"{schema}, _broken string", {
        "allowNonNumericNumbers": "false", "columnNameOfCorruptRecord": "_broken"})
    # Only suspicious records are looked at a second time.
    not_json = F.col("_event._broken").isNotNull() & F.try_parse_json(F.col(column)).isNull()
    return (df.filter(F.col(column).isNotNull())
            .select(F.col(column), parsed.alias("_event"))
            .filter(~not_json).select("_event.*").drop("_broken"))


def event_time(df: DataFrame, column: str, fmt: str = "yyyy-MM-dd HH:mm:ss", name: str = "event_timestamp") -> DataFrame:
    """Event time from text."""
    return df.withColumn(name, X.parse_ts(column, fmt))


def event_time_ms(df: DataFrame, column: str, name: str = "event_timestamp") -> DataFrame:
    """Event time from epoch milliseconds."""
    return df.withColumn(name, X.from_millis(column))


def with_watermark(df: DataFrame, column: str = "event_timestamp", delay: str = "5 seconds") -> DataFrame:
    """Wait ``delay`` behind the newest event time before closing windows."""
    return df.withWatermark(column, delay)


def merged(sources: list[DataFrame], column: str = "event_timestamp", delay: str = "5 seconds") -> DataFrame:
    """Streams of one shape under one watermark, which follows the newest event of any: a silent source holds nothing up."""
    return with_watermark(reduce(DataFrame.unionByName, sources), column, delay)


def pass_through(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Chosen fields under new names, row by row (``{field: new name}``)."""
    return df.select(*[F.col(c).alias(n) for c, n in columns.items()])
