import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import at
from meterline.sinks.materialize import current
from meterline.sources.topics import stream_record_files
from meterline.streaming import events as E
from meterline.streaming import run
from meterline.streaming import windows as W

SCHEMA = "zone int, amount double, pickup string"


class Feed:
    """A folder of JSON lines that grows file by file."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files, self.start = spark, folder, 0, time.time() - 1000
        folder.mkdir()

    def add(self, *events):
        lines = [e if isinstance(e, str) else json.dumps(dict(zip(("zone", "amount", "pickup"), e))) for e in events]
        path = self.folder / f"{self.files:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        # The source takes files by their time; two written in one instant have no order.
        os.utime(path, (self.start + self.files * 2,) * 2)
        self.files += 1

    def stream(self, on_error="skip"):
        records = stream_record_files(self.spark, str(self.folder), files_per_batch=1)
        return E.with_watermark(E.event_time(E.parse_events(records, SCHEMA, on_error), "pickup"))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def run_all(df, tmp_path):
    run.start(df, str(tmp_path / "out"), str(tmp_path / "cp"), interval=None).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(str(tmp_path / "out"))


def test_late_rows_within_the_delay_count_and_closed_windows_stay(feed, tmp_path, rows):
    feed.add((1, 1.0, "2024-01-01 00:59:58"), (1, 1.0, "2024-01-01 01:00:02"))
    feed.add((1, 1.0, "2024-01-01 00:59:59"))   # 3 s late: within the delay
    feed.add((1, 1.0, "2024-01-01 03:00:00"))   # closes the first two hours
    feed.add((1, 1.0, "2024-01-01 03:00:10"))   # the drop of late rows follows one batch behind
    feed.add((1, 50.0, "2024-01-01 00:30:00"))  # far behind a closed window
    feed.add((1, 0.0, "2024-01-02 00:00:00"))
    out = run_all(W.tumbling_zone_revenue(feed.stream(), "event_timestamp", "zone", "amount"), tmp_path)
    assert rows(out, "window_start", "num_trips", "total_revenue")[0] == (at("2024-01-01 00:00:00"), 2, 2.0)
    assert out.filter("total_revenue >= 50").count() == 0


def test_restart_goes_on_from_the_checkpoint(feed, tmp_path, rows):
    feed.add((1, 1.0, "2024-01-01 00:10:00"), (1, 1.0, "2024-01-01 00:50:00"))
    windows = lambda: W.tumbling_zone_count(feed.stream(), "event_timestamp", "zone", "1 hour")
    assert run_all(windows(), tmp_path).count() == 0
    feed.add((1, 1.0, "2024-01-01 00:55:00"))
    feed.add((1, 1.0, "2024-01-01 04:00:00"))
    assert rows(run_all(windows(), tmp_path), "window_start", "num_trips") == [(at("2024-01-01 00:00:00"), 3)]


def test_session_gap_is_inclusive_for_batch_and_stream(spark, feed, tmp_path, rows):
    times = ["2024-01-01 00:00:00", "2024-01-01 00:05:00", "2024-01-01 00:10:01", "2024-01-01 00:10:01"]
    feed.add(*[(1, 1.0, t) for t in times], (2, 1.0, times[0]))
    feed.add((9, 0.0, "2024-01-02 00:00:00"))
    feed.add((9, 0.0, "2024-01-03 00:00:00"))
    stream = run_all(W.session_zone_count(feed.stream(), "event_timestamp", "zone"), tmp_path)
    get = lambda df: sorted((r.window_start, r.window_end, r.zone, r.num_trips)
                            for r in df.filter("zone <> 9").collect())
    want = sorted([(at("2024-01-01 00:00:00"), at("2024-01-01 00:10:00"), 1, 2),
                   (at("2024-01-01 00:10:01"), at("2024-01-01 00:15:01"), 1, 2),
                   (at("2024-01-01 00:00:00"), at("2024-01-01 00:05:00"), 2, 1)])
    assert get(stream) == want
    batch = spark.createDataFrame([(1, t) for t in times] + [(2, times[0]), (2, None)], "zone int, t string").select(
        "zone", F.to_timestamp("t").alias("ts"))
    assert get(W.session_zone_count(batch, "ts", "zone")) == want
    distinct = {(r.zone, r.window_start): r.distinct_times for r in W.session_distinct_times(batch, "ts", "zone").collect()}
    assert distinct[(1, at("2024-01-01 00:10:01"))] == 1


def test_batch_sessions_equal_the_built_in_window(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("int").alias("zone"),
                                  F.timestamp_micros((F.pmod(F.hash("id"), F.lit(4_000_000)).cast("bigint") * 1_000_000)
                                                     + F.col("id")).alias("ts"))
    key = lambda r: tuple(r)
    mine = W.session_zone_count(df, "ts", "zone", 700).collect()
    plain = (df.groupBy(F.session_window("ts", "700 seconds").alias("w"), "zone").agg(F.count("*").alias("n"))
             .select("w.start", "w.end", "zone", "n").collect())
    assert sorted(map(key, mine)) == sorted(map(key, plain))


def test_bad_records_are_skipped_or_stop_the_job(feed, tmp_path, spark):
    feed.add((1, 1.0, "2024-01-01 00:00:00"), '{"zone": 1, "amo', '{"zone": "x", "amount": 2.0, "pickup": null}',
             '{"zone": 2, "amount": NaN, "pickup": "2024-01-01 00:00:00"}')
    out = run_all(feed.stream().select("zone", "amount"), tmp_path)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted([(1, 1.0), (None, 2.0)], key=repr)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        run_all(feed.stream("fail"), tmp_path / "strict")


def test_upsert_replaces_rows_and_survives_a_rerun(spark, feed, tmp_path, rows):
    feed.add((1, 1.0, "2024-01-01 00:10:00"))
    feed.add((1, 2.0, "2024-01-01 00:20:00"), (2, 5.0, "2024-01-01 01:20:00"))
    target = str(tmp_path / "table")
    windows = W.tumbling_zone_revenue(feed.stream(), "event_timestamp", "zone", "amount")
    for attempt in ("a", "b"):  # a lost checkpoint replays everything
        run.stream_upsert(windows, target, ["window_start", "zone"], str(tmp_path / attempt), interval=None,
                          day_of="window_start").awaitTermination()
    assert rows(current(spark, target), "window_start", "zone", "num_trips", "total_revenue") == [
        (at("2024-01-01 00:00:00"), 1, 2, 3.0), (at("2024-01-01 01:00:00"), 2, 1, 5.0)]


def test_a_replayed_batch_is_skipped(spark, feed, tmp_path, monkeypatch):
    """The driver is lost after the commit of a batch and before the stream notes that it is done."""
    feed.add((1, 1.0, "2024-01-01 00:10:00"))
    feed.add((1, 2.0, "2024-01-01 00:20:00"))
    target, checkpoint = str(tmp_path / "table"), str(tmp_path / "cp")
    store = run.materialize

    def lost(rows_, *args, **more):
        store(rows_, *args, **more)
        raise OSError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(run, "materialize", lost)
        with pytest.raises(Exception, match="driver lost"):
            run.stream_append(feed.stream(), target, checkpoint, interval=None).awaitTermination()
    assert current(spark, target).count() == 1
    for _ in range(2):
        run.stream_append(feed.stream(), target, checkpoint, interval=None).awaitTermination()
    assert current(spark, target).count() == 2


def test_a_replayed_upsert_keeps_the_state(spark, feed, tmp_path, rows, monkeypatch):
    feed.add((1, 1.0, "2024-01-01 00:10:00"))
    feed.add((1, 2.0, "2024-01-01 00:20:00"))
    target, checkpoint = str(tmp_path / "table"), str(tmp_path / "cp")
    store = run.materialize
    start = lambda: run.stream_upsert(W.tumbling_zone_revenue(feed.stream(), "event_timestamp", "zone", "amount"), target,
                                      ["window_start", "zone"], checkpoint, interval=None, day_of="window_start").awaitTermination()

    def lost(rows_, *args, **more):
        store(rows_, *args, **more)
        raise OSError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(run, "materialize", lost)
        with pytest.raises(Exception, match="driver lost"):
            start()
    start()
    assert rows(current(spark, target), "zone", "num_trips", "total_revenue") == [(1, 2, 3.0)]


def test_an_upsert_of_the_whole_table_must_be_asked_for(spark, feed, tmp_path):
    feed.add((1, 1.0, "2024-01-01 00:10:00"))
    windows = W.tumbling_zone_revenue(feed.stream(), "event_timestamp", "zone", "amount")
    with pytest.raises(ValueError, match="whole_table"):
        run.stream_upsert(windows, str(tmp_path / "t"), ["window_start", "zone"], str(tmp_path / "cp"))
    run.stream_upsert(windows, str(tmp_path / "t"), ["window_start", "zone"], str(tmp_path / "cp"), interval=None,
                      whole_table=True).awaitTermination()
    assert current(spark, str(tmp_path / "t")).count() == 1


def test_idle_files_do_not_stall_the_watermark(feed, tmp_path, rows):
    """One source goes silent; the other's events still close windows."""
    feed.add((1, 1.0, "2024-01-01 00:10:00"))
    for hour in (2, 3):
        feed.add((2, 1.0, f"2024-01-01 {hour:02d}:10:00"))
    out = run_all(W.tumbling_zone_count(feed.stream(), "event_timestamp", "zone", "1 hour"), tmp_path)
    assert (at("2024-01-01 00:00:00"), 1, 1) in rows(out, "window_start", "zone", "num_trips")


def test_database_stream_appends_each_batch(feed, tmp_path, monkeypatch):
    feed.add((1, 1.0, "2024-01-01 00:10:00"))
    feed.add((2, 1.0, "2024-01-01 00:20:00"), (3, 1.0, "2024-01-01 00:20:00"))
    calls = []
    monkeypatch.setattr(run, "write_jdbc", lambda df, url, table, mode, **o: calls.append((table, mode, df.count())))
    run.stream_to_jdbc(feed.stream(), "jdbc:none", "events", str(tmp_path / "cp"), interval=None).awaitTermination()
    assert calls == [("events", "append", 1), ("events", "append", 2)]


def test_distinct_times_on_a_stream_are_exact(feed, tmp_path, rows):
    feed.add((1, 1.0, "2024-01-01 00:00:00"), (1, 1.0, "2024-01-01 00:00:00"), (1, 1.0, "2024-01-01 00:04:00"), (2, 1.0, "2024-01-01 00:01:00"))
    feed.add((1, 1.0, "2024-01-01 00:04:01"), (1, 1.0, "2024-01-01 00:04:00"), (9, 1.0, "2024-01-02 00:00:00"))
    feed.add((1, 7.0, "2024-01-01 00:00:00"), (9, 1.0, "2024-01-03 00:00:00"))  # the first comes too late
    out = run_all(W.session_distinct_times(feed.stream(), "event_timestamp", "zone"), tmp_path)
    assert rows(out.filter("zone < 9"), "zone", "num_trips", "distinct_times") == [(1, 5, 3), (2, 1, 1)]


def test_sessions_of_one_zone_over_many_blocks(spark, rows):
    events = [(1 if i % 3 else 2, at("2024-01-01") + dt.timedelta(seconds=s)) for i, s in enumerate(sorted([*range(0, 9000, 170), *range(20000, 30000, 301)]))]
    frame = spark.createDataFrame(events, "zone int, ts timestamp")
    want = []
    for zone in (1, 2):
        for t in sorted(t for z, t in events if z == zone):
            if want and want[-1][0] == zone and (t - want[-1][2]).total_seconds() <= 300:
                want[-1] = (zone, want[-1][1], t, want[-1][3] + 1)
            else:
                want.append((zone, t, t, 1))
    for block in (2, 5, 1000):
        got = W._batch_sessions(frame, "ts", "zone", 300, False, task_rows=block)
        assert rows(got, "zone", "window_start", F.col("window_end") - F.expr("interval 300 seconds"), "num_trips") == sorted(want, key=repr)


def test_a_processing_time_trigger_takes_what_arrives(feed, tmp_path, spark):
    feed.add((1, 1.0, "2024-01-01 00:10:00"))
    query = run.start(feed.stream(), str(tmp_path / "out"), str(tmp_path / "cp"), interval="1 second")
    try:
        query.processAllAvailable()
        feed.add((2, 2.0, "2024-01-01 00:20:00"))
        query.processAllAvailable()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 2
        assert query.lastProgress["batchId"] >= 1
    finally:
        query.stop()
