"""Event-time windows over events, the same call for batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.operators.aggregates import top_k
from meterline.operators.ordered import TASK_ROWS, runs


def _tumbling(df: DataFrame, ts: str, size: str, keys: list[str], measures: list[Column]) -> DataFrame:
    grouped = df.groupBy(F.window(ts, size).alias("_window"), *keys).agg(*measures)
    names = [c for c in grouped.columns if c != "_window"]
    return grouped.select(F.col("_window.start").alias("window_start"),
                          F.col("_window.end").alias("window_end"), *names)


def tumbling_zone_revenue(df: DataFrame, ts: str, zone: str, amount: str, size: str = "1 hour") -> DataFrame:
    return _tumbling(df, ts, size, [zone], [F.count("*").alias("num_trips"), F.sum(amount).alias("total_revenue")])


def tumbling_zone_count(df: DataFrame, ts: str, zone: str, size: str = "5 minutes") -> DataFrame:
    return _tumbling(df, ts, size, [zone], [F.count("*").alias("num_trips")])


def tumbling_tips(df: DataFrame, ts: str, amount: str, size: str = "1 hour") -> DataFrame:
    return _tumbling(df, ts, size, [], [F.sum(amount).alias("total_tip_amount")])


def _batch_sessions(df: DataFrame, ts: str, zone: str, gap_seconds: int, distinct: bool, task_rows: int = TASK_ROWS) -> DataFrame:
    """Sessions of a batch without bringing a zone's events together.

    Two events in one slot of the gap's width are never further apart than the
    gap, so a slot lies inside one session. Slots are counted map-side; the
    sessions of the slots are numbered over a range layout, so that a busy zone
    with a long history is not one task either.
    """
    gap = gap_seconds * 1_000_000
    timed = df.filter(F.col(ts).isNotNull()).withColumn("_slot", F.floor(F.unix_micros(ts) / F.lit(gap)))
    if distinct:
        timed = timed.groupBy(zone, "_slot", ts).agg(F.count("*").alias("_n"))
        counts = [F.sum("_n").alias("_n"), F.count("*").alias("_times")]
    else:
        counts = [F.count("*").alias("_n")]
    slots = timed.groupBy(zone, "_slot").agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), *counts)
    silence = lambda w: F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(w))
    sessions = (
        runs(slots, [zone], ["_slot"], lambda w: F.coalesce(silence(w) > gap, F.lit(True)), "_session", task_rows)
        .groupBy(zone, "_session")
        .agg(F.min("_first").alias("window_start"),
             (F.max("_last") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("window_end"),
             F.sum("_n").alias("num_trips"),
             *([F.sum("_times").alias("distinct_times")] if distinct else []))
    )
    return sessions.select("window_start", "window_end", zone, "num_trips",
                           *(["distinct_times"] if distinct else []))


def _stream_sessions(df: DataFrame, ts: str, zone: str, gap_seconds: int, measures: list[Column]) -> DataFrame:
    grouped = df.groupBy(F.session_window(ts, f"{gap_seconds} seconds").alias("_window"), zone).agg(*measures)
    names = [c for c in grouped.columns if c != "_window"]
    return grouped.select(F.col("_window.start").alias("window_start"),
                          F.col("_window.end").alias("window_end"), *names)


def session_zone_count(df: DataFrame, ts: str, zone: str, gap_seconds: int = 300) -> DataFrame:
    """Sessions per zone: a silence longer than the gap ends one; exactly the gap does not."""
    if df.isStreaming:
        return _stream_sessions(df, ts, zone, gap_seconds, [F.count("*").alias("num_trips")])
    return _batch_sessions(df, ts, zone, gap_seconds, distinct=False)


def session_distinct_times(df: DataFrame, ts: str, zone: str, gap_seconds: int = 300) -> DataFrame:
    """Also the distinct event times of each session, exact for batches and streams.

    On a stream two stateful steps follow each other: events of one zone and time are counted once the watermark
    has passed that time, and the counted times form the sessions.
    """
    if df.isStreaming:
        times = df.groupBy(ts, zone).agg(F.count("*").alias("_n"))
        return _stream_sessions(times, ts, zone, gap_seconds, [F.sum("_n").alias("num_trips"), F.count("*").alias("distinct_times")])
    return _batch_sessions(df, ts, zone, gap_seconds, distinct=True)


def top_windows(windows: DataFrame, measure: str, k: int) -> DataFrame:
    """The k largest windows of a result table."""
    ties = [F.col(c) for c in windows.columns if c != measure]
    return top_k(windows, [F.col(measure).desc(), *ties], k)
