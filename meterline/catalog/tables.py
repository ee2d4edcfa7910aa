"""Materialisation strategies, run over whole tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.catalog import query
from meterline.catalog.common import over
from meterline.fixtures import TIE_BREAK, events, trips
from meterline.session import work_path
from meterline.sinks import materialize as M

_ALL = "event_id, ts, user_id, event_type, value, props"


@query("M01", f"SELECT {_ALL} FROM events")
def materialize_view(spark, folder):
    M.materialize(events(spark, folder), "meterline_view", "view")
    return spark.table("meterline_view")


@query("M02 M08", f"SELECT {_ALL} FROM events")
def materialize_table(spark, folder):
    path, rows = work_path(spark, "table"), events(spark, folder)
    M.materialize(rows.filter("event_id % 2 = 0"), path, "table")
    M.materialize(rows, path, "merge", keys=["event_id"], full_refresh=True)
    return M.current(spark, path)


@query("M03", f"SELECT {_ALL} FROM events UNION ALL SELECT {_ALL} FROM events WHERE event_id % 3 = 0")
def materialize_append(spark, folder):
    path, rows = work_path(spark, "append"), events(spark, folder)
    M.materialize(rows, path, "append", batch=("loader", 1))
    for _ in range(2):  # the second is the first again and changes nothing
        M.materialize(rows.filter("event_id % 3 = 0"), path, "append", batch=("loader", 2))
    return M.current(spark, path)


def _old_and_new(spark, folder):
    """Stored: two thirds of the events. New: half of all, with changed values."""
    rows = events(spark, folder)
    return rows.filter("event_id % 3 <> 0"), rows.filter("event_id % 2 = 0").withColumn("value", -F.col("value") - 1)


_MERGED = """
SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 2 = 0 THEN -value - 1 ELSE value END AS value, props
FROM events WHERE event_id % 3 <> 0 OR event_id % 2 = 0"""


@query("M04 Q12", _MERGED)
def materialize_merge(spark, folder):
    path = work_path(spark, "merge")
    old, new = _old_and_new(spark, folder)
    M.materialize(old, path, "table")
    for _ in range(2):
        M.materialize(new, path, "merge", keys=["event_id"])
    return M.current(spark, path)


@query("M04", _MERGED)
def materialize_merge_by_day(spark, folder):
    path = work_path(spark, "merge-days")
    old, new = _old_and_new(spark, folder)
    M.materialize(old, path, "table", keys=["event_id"], day_of="ts")
    M.materialize(new, path, "merge", keys=["event_id"], day_of="ts")
    return M.current(spark, path)


_INTERVAL = """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE NOT (ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-12') UNION ALL
SELECT event_id, ts, user_id, event_type, value + 1, props FROM events
WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-11' AND event_id % 2 = 0"""


def _interval(spark, folder, day_of):
    path, rows = work_path(spark, "interval"), events(spark, folder)
    bounds = {"start": "2024-01-05 06:00:00", "end": "2024-01-12 00:00:00"}
    M.materialize(rows, path, "table", day_of=day_of)
    fresh = (rows.filter("ts >= timestamp'2024-01-05 06:00:00' AND ts < timestamp'2024-01-11' AND event_id % 2 = 0")
             .withColumn("value", F.col("value") + 1))
    for _ in range(2):
        M.materialize(fresh, path, "time_interval", time_column="ts", day_of=day_of, **bounds)
    return M.current(spark, path)


@query("M05", _INTERVAL)
def materialize_interval(spark, folder):
    return _interval(spark, folder, None)


@query("M05", _INTERVAL)
def materialize_interval_by_day(spark, folder):
    """Only the touched days are rewritten; a day left without rows disappears."""
    return _interval(spark, folder, "ts")


_DELETED = """
SELECT * FROM events WHERE event_type IN ('click', 'error') AND event_id % 2 = 0 UNION ALL
SELECT * FROM events WHERE event_type NOT IN ('click', 'error')"""


def _delete_insert(spark, folder, day_of):
    path, rows = work_path(spark, "delete-insert"), events(spark, folder)
    M.materialize(rows, path, "table", keys=["event_type"], day_of=day_of)
    M.materialize(rows.filter("event_type IN ('click', 'error') AND event_id % 2 = 0"), path, "delete+insert",
                  keys=["event_type"], day_of=day_of)
    return M.current(spark, path)


@query("M06", _DELETED)
def materialize_delete_insert(spark, folder):
    return _delete_insert(spark, folder, None)


@query("M06", _DELETED)
def materialize_delete_insert_by_day(spark, folder):
    return _delete_insert(spark, folder, "ts")


@query("M07 C08 F11", over(f"""
SELECT {', '.join(TIE_BREAK)}, pickup_datetime FROM trips
WHERE pickup_datetime > (SELECT max(pickup_datetime) FROM trips WHERE pickup_datetime < TIMESTAMP '1998-07-01')"""))
def incremental_filter(spark, folder):
    path = work_path(spark, "increment")
    rows = trips(spark, folder).select(*TIE_BREAK, "pickup_datetime")
    M.materialize(rows.filter("pickup_datetime < timestamp'1998-07-01'"), path, "table")
    return M.incremental_filter(rows, path, "pickup_datetime")


@query("M09", """
SELECT *, TIMESTAMP '2024-02-01' AS valid_from,
       CASE WHEN event_id % 3 = 0 OR event_id % 2 = 0 THEN TIMESTAMP '2024-02-02' END AS valid_to
FROM events WHERE event_id % 5 <> 0 UNION ALL
SELECT * REPLACE (value + 1 AS value), TIMESTAMP '2024-02-02', NULL FROM events
WHERE event_id % 3 <> 0 AND event_id % 2 = 0 AND event_id % 5 <> 0 UNION ALL
SELECT * REPLACE (value + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS value), TIMESTAMP '2024-02-02', NULL FROM events
WHERE event_id % 3 <> 0 AND event_id % 5 = 0""")
def snapshot(spark, folder):
    """A day later every third row is gone, even rows changed, every fifth is new."""
    path, rows = work_path(spark, "snapshot"), events(spark, folder)
    columns = ["ts", "user_id", "event_type", "value", "props"]
    later = rows.filter("event_id % 3 <> 0").withColumn(
        "value", F.col("value") + F.when(F.col("event_id") % 2 == 0, 1).otherwise(0))
    M.snapshot(rows.filter("event_id % 5 <> 0"), path, ["event_id"], columns, "2024-02-01")
    M.snapshot(later, path, ["event_id"], columns, "2024-02-02")
    return M.current(spark, path)
