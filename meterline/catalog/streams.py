"""Event-window queries: as batches, and as streams run to the end of their input."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.catalog import query
from meterline.catalog.common import rounded
from meterline.fixtures import events
from meterline.functions import scalars as X
from meterline.session import prepare, work_path
from meterline.sinks.files import to_json_records
from meterline.sinks.materialize import current
from meterline.sources.topics import read_record_files, stream_record_files
from meterline.streaming import events as E
from meterline.streaming import run
from meterline.streaming import windows as W

EVENTS_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"

_BUCKET = "time_bucket(INTERVAL '{size}', ts)"


def _tumbling_sql(size: str, keys: str, measures: str, closed: bool = False) -> str:
    having = "" if not closed else (
        f" HAVING {_BUCKET.format(size=size)} + INTERVAL '{size}' <= "
        "(SELECT max(ts) - INTERVAL '5 seconds' FROM events)")
    group = "1, 2, event_type" if keys else "1, 2"
    return (f"SELECT {_BUCKET.format(size=size)} AS window_start, "
            f"{_BUCKET.format(size=size)} + INTERVAL '{size}' AS window_end, {keys} {measures} "
            f"FROM events GROUP BY {group}{having}")


_REVENUE = "count(*) AS num_trips, round(sum(value), 2) AS total_revenue"
_TIPS = "round(sum(value), 2) AS total_tip_amount"
_COUNT = "count(*) AS num_trips"

_SESSIONS = """
SELECT min(ts) AS window_start, max(ts) + INTERVAL '5 minutes' AS window_end, event_type, count(*) AS num_trips{more}
FROM (SELECT *, sum(opens) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s
      FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) <= INTERVAL '5 minutes'
                           THEN 0 ELSE 1 END AS opens FROM events))
GROUP BY event_type, s{closed}"""
_CLOSED_SESSION = """
HAVING max(ts) + INTERVAL '5 minutes' <= (SELECT max(ts) - INTERVAL '5 seconds' FROM events)"""


@query("T04", _tumbling_sql("1 hour", "event_type,", _REVENUE))
def tumbling_zone_revenue(spark, folder):
    return rounded(W.tumbling_zone_revenue(events(spark, folder), "ts", "event_type", "value"), 2, "total_revenue")


@query("T05", _tumbling_sql("5 minutes", "event_type,", _COUNT))
def tumbling_zone_count(spark, folder):
    return W.tumbling_zone_count(events(spark, folder), "ts", "event_type")


@query("T06", _SESSIONS.format(more="", closed=""))
def session_zone_count(spark, folder):
    return W.session_zone_count(events(spark, folder), "ts", "event_type")


@query("T07", _tumbling_sql("1 hour", "", _TIPS))
def tumbling_tips(spark, folder):
    return rounded(W.tumbling_tips(events(spark, folder), "ts", "value"), 2, "total_tip_amount")


@query("T08", "SELECT event_type AS zone, value AS amount, ts AS event_timestamp FROM events")
def pass_through(spark, folder):
    return E.pass_through(events(spark, folder), {"event_type": "zone", "value": "amount", "ts": "event_timestamp"})


@query("T14", f"""
SELECT * FROM ({_tumbling_sql("5 minutes", "event_type,", _COUNT)})
ORDER BY num_trips DESC, window_start, window_end, event_type LIMIT 3""")
def busiest_window(spark, folder):
    return W.top_windows(W.tumbling_zone_count(events(spark, folder), "ts", "event_type"), "num_trips", 3)


@query("T14", f"""
SELECT * FROM ({_SESSIONS.format(more="", closed="")})
ORDER BY num_trips DESC, window_start, window_end, event_type LIMIT 5""")
def longest_session(spark, folder):
    return W.top_windows(W.session_zone_count(events(spark, folder), "ts", "event_type"), "num_trips", 5)


@query("T14", f"""
SELECT * FROM ({_tumbling_sql("1 hour", "", _TIPS)}) ORDER BY total_tip_amount DESC, window_start LIMIT 5""")
def best_tip_hour(spark, folder):
    hours = rounded(W.tumbling_tips(events(spark, folder), "ts", "value"), 2, "total_tip_amount")
    return W.top_windows(hours, "total_tip_amount", 5)


@query("T15", _SESSIONS.format(more=", count(DISTINCT ts) AS distinct_times", closed=""))
def session_distinct_times(spark, folder):
    return W.session_distinct_times(events(spark, folder), "ts", "event_type")


def _event_stream(spark, folder):
    # A pattern, because the table may be one file or a folder of files.
    source = prepare(spark).readStream.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parque[t]")
    return E.with_watermark(source, "ts", "5 seconds")


def _to_end(df, name):
    """Run a stream over all input there is and read what it wrote."""
    spark = df.sparkSession
    target = work_path(spark, name)
    run.start(df, target, work_path(spark, f"{name}-checkpoint"), interval=None).awaitTermination()
    return spark.read.schema(df.schema).parquet(target)


@query("T03 T04", _tumbling_sql("1 hour", "event_type,", _REVENUE, closed=True))
def stream_tumbling_zone_revenue(spark, folder):
    """Windows the watermark has closed; the last open ones are not written in append mode."""
    out = _to_end(W.tumbling_zone_revenue(_event_stream(spark, folder), "ts", "event_type", "value"), "revenue")
    return rounded(out, 2, "total_revenue")


@query("T03 T05", _tumbling_sql("5 minutes", "event_type,", _COUNT, closed=True))
def stream_tumbling_zone_count(spark, folder):
    return _to_end(W.tumbling_zone_count(_event_stream(spark, folder), "ts", "event_type"), "counts")


@query("T03 T06", _SESSIONS.format(more="", closed=_CLOSED_SESSION))
def stream_session_zone_count(spark, folder):
    return _to_end(W.session_zone_count(_event_stream(spark, folder), "ts", "event_type"), "sessions")


@query("T03 T07", _tumbling_sql("1 hour", "", _TIPS, closed=True))
def stream_tumbling_tips(spark, folder):
    out = _to_end(W.tumbling_tips(_event_stream(spark, folder), "ts", "value"), "tips")
    return rounded(out, 2, "total_tip_amount")


@query("T08", "SELECT event_type AS zone, value AS amount, ts AS event_timestamp FROM events")
def stream_pass_through(spark, folder):
    return _to_end(E.pass_through(_event_stream(spark, folder), {
        "event_type": "zone", "value": "amount", "ts": "event_timestamp"}), "rows")


@query("T03 T15", _SESSIONS.format(more=", count(DISTINCT ts) AS distinct_times", closed=_CLOSED_SESSION))
def stream_session_distinct_times(spark, folder):
    return _to_end(W.session_distinct_times(_event_stream(spark, folder), "ts", "event_type"), "distinct-times")


_FIRST_CUT, _SECOND_CUT = "TIMESTAMP '2024-01-10 12:30:00'", "TIMESTAMP '2024-01-20 12:30:00'"


def _fed(spark, slices, build, name):
    """Land slices of several sources one after the other; each time the stream starts again from its checkpoint
    and takes what is new. ``slices`` are lists with a frame, or None for nothing new, per source."""
    feeds = [work_path(spark, f"{name}-feed-{i}") for i in range(len(slices[0]))]
    target, checkpoint = work_path(spark, name), work_path(spark, f"{name}-checkpoint")
    for landed in slices:
        for feed, rows in zip(feeds, landed):
            if rows is not None:
                rows.write.mode("append").parquet(feed)
        df = build(*[prepare(spark).readStream.schema(EVENTS_SCHEMA).parquet(feed) for feed in feeds])
        run.start(df, target, checkpoint, interval=None).awaitTermination()
    return spark.read.schema(df.schema).parquet(target)


_TOO_LATE = f"event_id % 50 = 0 AND ts < {_FIRST_CUT} - INTERVAL 1 DAY"
_A_LITTLE_LATE = f"event_id % 2 = 1 AND ts >= {_FIRST_CUT} - INTERVAL 20 MINUTE AND ts < {_FIRST_CUT}"


@query("T03 T10", _tumbling_sql("1 hour", "event_type,", _COUNT, closed=True).replace(
    "FROM events GROUP", f"FROM events WHERE NOT ({_TOO_LATE}) GROUP"))
def stream_late_rows(spark, folder):
    """Rows behind the watermark count while their window is open; rows of closed windows are dropped."""
    rows = events(spark, folder)
    kept = rows.filter(f"NOT ({_TOO_LATE})")
    slices = [kept.filter(f"ts < {_FIRST_CUT} AND NOT ({_A_LITTLE_LATE})"),
              kept.filter(f"(ts >= {_FIRST_CUT} AND ts < {_SECOND_CUT}) OR ({_A_LITTLE_LATE})"),
              rows.filter(f"ts >= {_SECOND_CUT} OR ({_TOO_LATE})")]
    return _fed(spark, [[s] for s in slices], lambda stream: W.tumbling_zone_count(
        E.with_watermark(stream, "ts", "5 seconds"), "ts", "event_type", "1 hour"), "late")


_SILENT = f"event_type IN ('click', 'error') AND ts >= {_FIRST_CUT}"


@query("T03 T13", _tumbling_sql("1 hour", "event_type,", _COUNT, closed=True).replace(
    "FROM events GROUP", f"FROM events WHERE NOT ({_SILENT}) GROUP"))
def stream_silent_source(spark, folder):
    """One of two sources has nothing more after the first slice; its windows close all the same."""
    rows = events(spark, folder)
    silent, going = rows.filter(f"event_type IN ('click', 'error') AND ts < {_FIRST_CUT}"), rows.filter("event_type NOT IN ('click', 'error')")
    slices = [[silent, going.filter(f"ts < {_FIRST_CUT}")],
              [None, going.filter(f"ts >= {_FIRST_CUT} AND ts < {_SECOND_CUT}")],
              [None, going.filter(f"ts >= {_SECOND_CUT}")]]
    return _fed(spark, slices, lambda a, b: W.tumbling_zone_count(
        E.merged([a, b], "ts", "5 seconds"), "ts", "event_type", "1 hour"), "silent")


@query("K13 T04", _tumbling_sql("1 hour", "event_type,", _REVENUE))
def stream_upsert(spark, folder):
    """Keyed result table in update mode: open windows are there too."""
    windows = W.tumbling_zone_revenue(_event_stream(spark, folder), "ts", "event_type", "value")
    target = work_path(spark, "upsert")
    run.stream_upsert(windows, target, ["window_start", "event_type"], work_path(spark, "upsert-checkpoint"),
                      interval=None, day_of="window_start").awaitTermination()
    return rounded(current(spark, target), 2, "total_revenue")


_GREEN_EVENT = "event_id bigint, event_type string, value double, lpep_pickup_datetime string"


def _record_files(spark, folder, ts):
    """Events as landed JSON records, with text or epoch-millisecond times."""
    path = work_path(spark, f"records-{ts}")
    records = events(spark, folder).select("event_id", "event_type", "value", F.col("ts").alias("lpep_pickup_datetime"))
    to_json_records(records, ts=ts).write.text(path)
    return path


@query("K10 T01 X08 X11 X17", """
SELECT event_id, event_type, value, date_trunc('second', ts) AS event_timestamp FROM events""")
def topic_text_times(spark, folder):
    records = read_record_files(spark, _record_files(spark, folder, "text"))
    return E.event_time(E.parse_events(records, _GREEN_EVENT), "lpep_pickup_datetime").drop("lpep_pickup_datetime")


@query("K11 T02 X09 X10 X17", """
SELECT event_id, event_type, value, date_trunc('millisecond', ts) AS event_timestamp FROM events""")
def topic_millis_times(spark, folder):
    records = read_record_files(spark, _record_files(spark, folder, "millis"))
    parsed = E.parse_events(records, _GREEN_EVENT.replace("datetime string", "datetime bigint"), on_error="fail")
    return E.event_time_ms(parsed, "lpep_pickup_datetime").drop("lpep_pickup_datetime")


@query("T01", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def stream_topic(spark, folder):
    """Record stream to typed rows to files, then one batch aggregate over the result."""
    records = stream_record_files(spark, _record_files(spark, folder, "text"))
    typed = E.event_time(E.parse_events(records, _GREEN_EVENT), "lpep_pickup_datetime")
    stored = _to_end(typed, "typed")
    return rounded(stored.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")), 2, "total")


@query("T09 Q11", """
SELECT count(*) FILTER (event_id % 10 <> 3) AS kept,
       count(value) FILTER (event_id % 10 NOT IN (3, 5)) AS with_value FROM events""")
def bad_record_policy(spark, folder):
    """Every tenth record is broken off and another tenth has text for a number."""
    whole = to_json_records(events(spark, folder).select("event_id", "value"))
    number = F.get_json_object("value", "$.event_id").cast("bigint")
    damaged = whole.select(
        F.when(number % 10 == 3, F.substring("value", 1, 12))
        .when(number % 10 == 5, F.regexp_replace("value", '"value":[0-9.E-]+', '"value":"x"'))
        .otherwise(F.col("value")).alias("value"))
    return E.parse_events(damaged, "event_id bigint, value double").agg(
        F.count("*").alias("kept"), F.count("value").alias("with_value"))
