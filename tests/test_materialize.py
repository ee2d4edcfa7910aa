import pytest
from pyspark.sql import functions as F

from conftest import at
from meterline.sinks import materialize as M


def frame(spark, *data):
    return spark.createDataFrame(list(data), "id int, ts timestamp, v string")


@pytest.fixture(params=[None, "ts"], ids=["versioned", "by_day"])
def day_of(request):
    return request.param


OLD = [(1, at("2024-01-01 05:00:00"), "a"), (2, at("2024-01-02 05:00:00"), "b"), (3, at("2024-01-03 05:00:00"), "c")]


def build(spark, path, day_of):
    M.materialize(frame(spark, *OLD), path, "table", day_of=day_of)
    return path


def test_merge_moves_rows_between_days_and_repeats_safely(spark, tmp_path, rows, day_of):
    path = build(spark, str(tmp_path / "t"), day_of)
    new = frame(spark, (2, at("2024-01-05 00:00:00"), "B"), (4, at("2024-01-01 00:00:00"), "d"))
    for _ in range(2):
        M.materialize(new, path, "merge", keys=["id"], day_of=day_of)
    assert rows(M.current(spark, path), "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def folders(spark, path):
    out = {}
    for f in M._latest(spark, path)["folders"]:
        out.setdefault(f["day"], set()).add(f["path"])
    return out


def test_merge_rewrites_only_touched_days(spark, tmp_path):
    path = build(spark, str(tmp_path / "t"), "ts")
    before = folders(spark, path)
    M.materialize(frame(spark, (1, at("2024-01-01 09:00:00"), "A")), path, "merge", keys=["id"], day_of="ts")
    after = folders(spark, path)
    assert after["2024-01-03"] == before["2024-01-03"] and after["2024-01-02"] == before["2024-01-02"]
    assert after["2024-01-01"].isdisjoint(before["2024-01-01"])


def test_a_load_lost_before_its_commit_leaves_the_old_table(spark, tmp_path, rows, monkeypatch, day_of):
    path = build(spark, str(tmp_path / "t"), day_of)
    new = frame(spark, (2, at("2024-01-05 00:00:00"), "B"), (4, at("2024-01-01 00:00:00"), "d"))
    loads = {"merge": {"keys": ["id"]}, "delete+insert": {"keys": ["id"]}, "append": {}, "table": {},
             "time_interval": {"time_column": "ts", "start": "2024-01-01", "end": "2024-01-03"}}
    with monkeypatch.context() as m:
        def lost(*_):
            raise OSError("driver lost")
        m.setattr(M, "_commit", lost)
        for strategy, more in loads.items():
            with pytest.raises(OSError):
                M.materialize(new, path, strategy, day_of=day_of, **more)
            assert rows(M.current(spark, path), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]
    M.materialize(new, path, "merge", keys=["id"], day_of=day_of)
    assert rows(M.current(spark, path), "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_of_two_writers_the_later_fails(spark, tmp_path, rows, monkeypatch, day_of):
    path = build(spark, str(tmp_path / "t"), day_of)
    store = M._store

    def overtaken(df, *args, **more):
        monkeypatch.setattr(M, "_store", store)
        M.materialize(frame(spark, (8, None, "first")), path, "append", day_of=day_of)
        return store(df, *args, **more)
    monkeypatch.setattr(M, "_store", overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        M.materialize(frame(spark, (9, None, "second")), path, "append", day_of=day_of)
    assert [i for i, in rows(M.current(spark, path), "id")] == [1, 2, 3, 8]


def test_a_repeated_batch_is_skipped(spark, tmp_path, rows, day_of):
    path = str(tmp_path / "t")
    load = lambda number, *ids: M.materialize(frame(spark, *[(i, at("2024-01-01"), "x") for i in ids]), path, "append",
                                              day_of=day_of, batch=("loader", number))
    assert load(0, 1, 2) and not load(0, 1, 2) and load(1, 3) and not load(1, 3) and not load(0, 1, 2)
    assert M.materialize(frame(spark, (4, None, "y")), path, "append", day_of=day_of, batch=("other", 0))
    assert rows(M.current(spark, path), "id") == [(1,), (2,), (3,), (4,)]
    assert M.committed(spark, path, "loader") == 1 and M.committed(spark, path, "nobody") is None


def test_merge_reads_only_days_that_can_hold_a_key(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    many = [(i, at(f"2024-01-{1 + i // 10:02d} 01:00:00"), "old") for i in range(100)] + [(None, at("2024-01-11"), "none")]
    M.materialize(frame(spark, *many), path, "table", keys=["id"], day_of="ts")
    new = frame(spark, (35, at("2024-01-20"), "moved"), (41, at("2024-01-20"), "moved"))
    record = M._latest(spark, path)
    fresh = M._store(new, path, "ts")
    M._add_key_ranges(new, fresh, ["id"], "ts")
    search = M.days_of_keys(spark, path, record, fresh, ["id"])
    stored = {f.split("_day=")[1].split("/")[0] for f in search.inputFiles()}
    assert stored == {"2024-01-04", "2024-01-05", "2024-01-20"}  # two old dates, and the new rows' own
    M.materialize(new, path, "merge", keys=["id"], day_of="ts")
    M.materialize(frame(spark, (None, at("2024-01-21"), "no key")), path, "merge", keys=["id"], day_of="ts")
    merged = rows(M.current(spark, path), "id", "v")
    assert len(merged) == 101 and {(35, "moved"), (41, "moved"), (None, "no key")} <= set(merged)
    # ranges noted by a merge still prune the next one
    record = M._latest(spark, path)
    assert {f["day"] for f in record["folders"] if M._may_share_keys(f, {"keys": {"id": [60, 62, False]}}, ["id"])} == {"2024-01-07"}


def test_an_interval_leaves_other_days_and_drops_inner_days_unread(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    M.materialize(frame(spark, *[(d, at(f"2024-01-{d:02d} 12:00:00"), "o") for d in range(1, 8)], (99, None, "t")), path, "table", day_of="ts")
    before = folders(spark, path)
    M.materialize(frame(spark).limit(0), path, "time_interval", time_column="ts", start="2024-01-02 06:00:00",
                  end="2024-01-06 06:00:00", day_of="ts")
    after = folders(spark, path)
    assert rows(M.current(spark, path), "id") == [(1,), (6,), (7,), (99,)]
    assert all(after[d] == before[d] for d in ("2024-01-01", "2024-01-07", None))
    assert not {"2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"} & set(after)


@pytest.mark.parametrize("period, first", [("month", {"2023-12-01", "2024-01-01", "2024-02-01"}), ("year", {"2023-01-01", "2024-01-01"})])
def test_longer_periods(spark, tmp_path, rows, period, first):
    path = str(tmp_path / "t")
    more = {"day_of": "ts", "period": period}
    M.materialize(frame(spark, *OLD, (4, at("2023-12-31 23:59:59"), "d"), (5, at("2024-02-29 01:00:00"), "e")), path, "table", keys=["id"], **more)
    assert set(folders(spark, path)) == first
    M.materialize(frame(spark, (4, at("2024-02-01 00:00:00"), "D")), path, "merge", keys=["id"], **more)
    M.materialize(frame(spark).limit(0), path, "time_interval", time_column="ts", start="2024-01-02", end="2024-02-15", **more)
    assert rows(M.current(spark, path), "id", "v") == [(1, "a"), (5, "e")]
    assert M.high_water(spark, path, "ts") == at("2024-02-29 01:00:00")


def test_loads_keep_to_one_layout(spark, tmp_path):
    path = build(spark, str(tmp_path / "t"), "ts")
    with pytest.raises(ValueError, match="stored by"):
        M.materialize(frame(spark, *OLD), path, "append")


def test_null_keys_are_replaced_too(spark, tmp_path, rows, day_of):
    path = build(spark, str(tmp_path / "t"), day_of)
    for _ in range(2):
        M.materialize(frame(spark, (None, None, "n")), path, "merge", keys=["id"], day_of=day_of)
    assert rows(M.current(spark, path), "id", "v") == sorted([(1, "a"), (2, "b"), (3, "c"), (None, "n")], key=repr)


def test_interval_replaces_half_open_range(spark, tmp_path, rows, day_of):
    path = build(spark, str(tmp_path / "t"), day_of)
    new = frame(spark, (9, at("2024-01-02 08:00:00"), "x"))
    for _ in range(2):
        M.materialize(new, path, "time_interval", time_column="ts", start="2024-01-01 05:00:00",
                      end="2024-01-03 05:00:00", day_of=day_of)
    assert rows(M.current(spark, path), "id") == [(3,), (9,)]


def test_interval_with_no_new_rows_only_deletes(spark, tmp_path, rows, day_of):
    path = build(spark, str(tmp_path / "t"), day_of)
    M.materialize(frame(spark).limit(0), path, "time_interval", time_column="ts", start="2024-01-02",
                  end="2024-01-03", day_of=day_of)
    assert rows(M.current(spark, path), "id") == [(1,), (3,)]


def test_delete_insert_replaces_whole_keys(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    M.materialize(frame(spark, *OLD, (1, at("2024-01-01 06:00:00"), "a2")), path, "table")
    M.materialize(frame(spark, (1, at("2024-01-09 00:00:00"), "z")), path, "delete+insert", keys=["id"])
    assert rows(M.current(spark, path), "id", "v") == [(1, "z"), (2, "b"), (3, "c")]


def test_drift_stops_the_load_and_refresh_rebuilds(spark, tmp_path, day_of):
    path = build(spark, str(tmp_path / "t"), day_of)
    wider = frame(spark, *OLD).withColumn("more", F.lit(1))
    with pytest.raises(ValueError, match="schema changed"):
        M.materialize(wider, path, "merge", keys=["id"], day_of=day_of)
    M.materialize(wider, path, "merge", keys=["id"], full_refresh=True, day_of=day_of)
    assert "more" in M.current(spark, path).columns


def test_unfinished_version_is_ignored(spark, tmp_path, rows):
    path = build(spark, str(tmp_path / "t"), None)
    frame(spark, (7, None, "half")).write.parquet(f"{path}/data/half")
    open(f"{path}/_commits/.half", "w").close()
    assert rows(M.current(spark, path), "id") == [(1,), (2,), (3,)]
    M.materialize(frame(spark, (4, None, "d")), path, "merge", keys=["id"])
    assert rows(M.current(spark, path), "id") == [(1,), (2,), (3,), (4,)]


def test_high_water_is_strict_unless_looked_back(spark, tmp_path, rows):
    path = build(spark, str(tmp_path / "t"), None)
    new = frame(spark, (3, at("2024-01-03 05:00:00"), "same"), (5, at("2024-01-03 05:00:01"), "next"))
    assert rows(M.incremental_filter(new, path, "ts"), "id") == [(5,)]
    assert rows(M.incremental_filter(new, path, "ts", lookback="1 hour"), "id") == [(3,), (5,)]
    assert M.incremental_filter(new, str(tmp_path / "none"), "ts").count() == 2


def test_snapshot_history(spark, tmp_path, rows):
    path = str(tmp_path / "s")
    day = lambda d, *r: M.snapshot(spark.createDataFrame(list(r), "id int, v string"), path, ["id"], ["v"], d)
    day("2024-01-01", (1, "a"), (2, "b"))
    day("2024-01-02", (1, "a"), (2, "B"))
    day("2024-01-03", (2, "B"), (3, None))
    day("2024-01-03", (2, "B"), (3, None))
    assert rows(M.current(spark, path), "id", "v", "valid_from", "valid_to") == sorted([
        (1, "a", at("2024-01-01"), at("2024-01-03")), (2, "b", at("2024-01-01"), at("2024-01-02")),
        (2, "B", at("2024-01-02"), None), (3, None, at("2024-01-03"), None)], key=repr)


def test_a_snapshot_writes_closed_rows_once_and_refuses_shared_keys(spark, tmp_path):
    path = str(tmp_path / "s")
    day = lambda d, *r: M.snapshot(spark.createDataFrame(list(r), "id int, v string"), path, ["id"], ["v"], d)
    day("2024-01-01", (1, "a"), (2, "b"))
    day("2024-01-02", (1, "A"), (2, "b"))
    closed = {f["path"] for f in M._latest(spark, path)["folders"] if f["part"] == "closed"}
    day("2024-01-03", (1, "A"), (2, "B"))
    day("2024-01-04", (1, "A"), (2, "B"))
    after = [f for f in M._latest(spark, path)["folders"] if f["part"] == "closed"]
    assert len(closed) == 1 and closed < {f["path"] for f in after} and len(after) == 2
    with pytest.raises(ValueError, match="share a key"):
        day("2024-01-05", (1, "A"), (1, "B"))
    assert M.current(spark, path).count() == 4


def test_view_append_and_unknown(spark, tmp_path):
    M.materialize(frame(spark, *OLD), "mat_view", "view")
    assert spark.table("mat_view").count() == 3
    path = str(tmp_path / "a")
    for _ in range(2):
        M.materialize(frame(spark, *OLD), path, "append", day_of="ts")
    assert M.current(spark, path).count() == 6
    with pytest.raises(ValueError):
        M.materialize(frame(spark, *OLD), path, "replace")


def test_rows_to_merge_may_not_share_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    M.materialize(spark.createDataFrame([(1, "a")], "id int, v string"), path, "merge", keys=["id"])
    with pytest.raises(Exception, match="share a key"):
        M.materialize(spark.createDataFrame([(2, "b"), (2, "c")], "id int, v string"), path, "merge", keys=["id"])
    assert [tuple(r) for r in M.current(spark, path).collect()] == [(1, "a")]


def test_older_versions_stay_readable_until_expired(spark, tmp_path):
    path = str(tmp_path / "t")
    first = None
    for k in range(4):
        M.materialize(spark.createDataFrame([(k, "a")], "id int, v string"), path, "table")
        first = first or M.current(spark, path)
    assert first.first()["id"] == 0
    M.expire_versions(spark, path, keep=1)
    assert M.current(spark, path).first()["id"] == 3


def test_the_fact_is_loaded_from_one_join(spark, monkeypatch):
    from meterline import fixtures
    from meterline.catalog import models
    calls, trips = [], fixtures.trips
    counted = lambda *a: (calls.append(a), trips(*a))[1]
    monkeypatch.setattr(models, "trips", counted)
    assert models.fct_trips_incremental(spark, "/root/testdata/sf0.001").count() > 0 and len(calls) == 1


def test_only_whole_keys_count_as_shared(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (2, None)], "i int, s string")
    same = F.lit(0)  # all hashes alike
    for hashed in (F.xxhash64, lambda *keys: same):
        monkeypatch.setattr(M.F, "xxhash64", hashed)
        M._refuse_shared_keys(df, ["i", "s"])
        for copy in ((1, "b"), (None, "a"), (2, None)):
            with pytest.raises(ValueError):
                M._refuse_shared_keys(df.unionByName(spark.createDataFrame([copy], df.schema)), ["i", "s"])
