import pytest
from pyspark.sql import functions as F

from conftest import at
from meterline.functions import scalars as X
from meterline.functions.scoring import predict_duration
from meterline.operators import aggregates as A
from meterline.operators import columns as P
from meterline.operators import filters
from meterline.operators.joins import lookup_join, outer_on_keys
from meterline.plans import models as M
from meterline.plans import reports as R


def test_minutes_are_boundaries_and_seconds_are_elapsed(spark):
    df = spark.createDataFrame([(at("2024-01-01 00:00:59"), at("2024-01-01 00:01:01"))], "a timestamp, b timestamp")
    assert tuple(df.select(X.minutes_between("a", "b"), X.seconds_between("a", "b")).first()) == (1, 2)


def test_coerce(spark):
    df = spark.createDataFrame([("1.0", "2.5", "2024-01-01 00:00:00"), ("x", "", "soon")], "i string, f string, t string")
    out = P.coerce(df, ints=["i", "absent"], floats=["f"], timestamps=["t"])
    assert [tuple(r) for r in out.collect()] == [(1, 2.5, at("2024-01-01 00:00:00")), (None, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        P.cast_strict(df, {"i": "int"}).collect()


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], ["  PU Location ID", "Drop_Off_datetime "])
    out = P.apply_aliases(P.normalize_headers(df), {"drop_off_datetime": "dropoff_datetime"})
    assert out.columns == ["pu_location_id", "drop_off_datetime", "dropoff_datetime"]
    assert P.apply_aliases(out, {"drop_off_datetime": "dropoff_datetime"}).columns == out.columns


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "null")], "x string, y string")
    assert df.select(P.surrogate_key("x", "y").alias("k")).distinct().count() == 3


def test_labels(spark):
    df = spark.createDataFrame([(1,), (3,), (None,)], "vendor_id int")
    assert [r[0] for r in df.select(M.vendor_name()).collect()] == ["Creative Mobile Technologies", None, None]


def test_numbers_that_are_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (6.0,), (5.0,)], "x double")
    assert tuple(A.count_over_threshold(df.select(X.finite_or_null("x").alias("x")), "x", 5.0).first()) == (5, 1)
    text = spark.createDataFrame([("6.5",), (None,), ("?",)], "x string").select(X.lenient_double("x").alias("x"))
    assert tuple(A.count_over_threshold(text, "x", 5.0).first()) == (3, 1)


def test_concat_key_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("a", 1), (None, 1)], "x string, y int")
    assert [r[0] for r in df.select(X.concat_key("x", "y")).collect()] == ["a|1", None]


def test_duplicates_count_rows_without_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (None, "a")], "p int, o string")
    assert tuple(A.duplicate_report(df, ["p"], ["o"]).first()) == (4, 2, 2)


def test_like_wildcard(spark):
    df = spark.createDataFrame([("green_tripdata",), ("greenXtripdata",)], "file_name string")
    assert df.filter(filters.file_like("green_trip%")).count() == 2


def test_lookup_join_roles_nulls_and_text_keys(spark, rows):
    zones = spark.createDataFrame([(1, "A"), (2, "B")], "LocationID int, Zone string")
    fact = spark.createDataFrame([("1", 2), ("x", 1), (None, None)], "p string, d int")
    out = lookup_join(lookup_join(fact, zones, "p", "LocationID", {"Zone": "pz"}), zones, "d", "LocationID", {"Zone": "dz"})
    assert rows(out, "pz", "dz") == sorted([("A", "B"), (None, "A"), (None, None)], key=repr)
    assert lookup_join(fact, zones, "p", "LocationID", {"Zone": "z"}, "inner").count() == 1


def test_lookup_size_is_left_to_the_engine(spark):
    zones = spark.range(50).select(F.col("id").cast("int").alias("LocationID"), F.lit("z").alias("Zone"))
    fact = spark.range(100).select((F.col("id") % 60).cast("int").alias("p"))
    spark.sparkContext.setJobGroup("lookup", "building a join")
    joined = lookup_join(fact, zones, "p", "LocationID", {"Zone": "z"})
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lookup")
    assert "strategy=broadcast" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.filter("z is null").count() == 10


def test_numbers_and_days(spark):
    rows = spark.createDataFrame([("9007199254740993", "NaN"), ("1.0", "inf"), ("x", "2.5")], "i string, d string")
    out = [tuple(r) for r in P.coerce(rows, ints=["i"], floats=["d"]).collect()]
    assert out == [(9007199254740993, None), (1, None), (None, 2.5)]
    assert A.count_over_threshold(spark.createDataFrame([(float("nan"),), (6.0,), (None,)], "x double"), "x", 5).first()["rows_over"] == 1
    moments = spark.createDataFrame([(at("2024-01-02T01:00:00"),), (at("2024-01-03T00:00:00"),)], "t timestamp")
    assert moments.filter(filters.on_day("t", at("2024-01-02T15:30:00"))).count() == 1


def test_outer_join_keeps_null_keys_apart(spark, rows):
    left = spark.createDataFrame([(1, None, 10.0)], "hour int, zone int, g double")
    right = spark.createDataFrame([(1, None, 20.0)], "hour int, zone int, y double")
    assert rows(outer_on_keys(left, right, ["hour", "zone"])) == sorted(
        [(1, None, 10.0, None), (1, None, None, 20.0)], key=repr)


def test_pair_label_is_null_with_an_unknown_side(spark):
    zones = spark.createDataFrame([(1, "A")], "LocationID int, Zone string")
    trips = spark.createDataFrame([(1, 9), (1, 9), (1, 1)], "pickup_location_id int, dropoff_location_id int")
    assert [tuple(r) for r in R.top_zone_pairs(trips, zones, 5).collect()] == [(None, 2), ("A / A", 1)]


def test_rdd_form_gives_the_same_hourly_revenue(spark):
    """The keyed reduce on an RDD, kept here only to compare."""
    data = [(at(f"2020-01-0{1 + i % 3} {i % 24:02d}:15:00"), i % 4, float(i)) for i in range(200)]
    df = spark.createDataFrame(data, "pickup_datetime timestamp, pickup_location_id int, total_amount double")
    pairs = (df.rdd.map(lambda r: ((r[0].replace(minute=0, second=0), r[1]), (r[2], 1)))
             .reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).collect())
    out = R.hourly_zone_revenue(df, "2019-01-01", amount="revenue", number="count").collect()
    assert sorted((h, z, v, n) for (h, z), (v, n) in pairs) == sorted(map(tuple, out))


def test_scoring_with_another_model(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0)], "id int, trip_distance double")
    assert sorted(map(tuple, predict_duration(df).collect())) == [(1, 2.0, 10.0), (2, 4.0, 20.0)]
    custom = predict_duration(df, lambda b: b["id"] + 0.5, ("id",), "minutes")
    assert sorted(r.minutes for r in custom.collect()) == [1.5, 2.5]


def test_report_bounds_must_be_midnights(spark):
    staged = spark.createDataFrame([], "pickup_datetime timestamp, taxi_type string, payment_type_name string, fare_amount double")
    M.trips_report({"staging_trips": staged}, "2024-01-01 00:00:00", "2024-02-01")
    with pytest.raises(ValueError, match="midnights"):
        M.trips_report({"staging_trips": staged}, "2024-01-01", "2024-02-01 06:00:00")


def test_example_chain(spark):
    one = spark.createDataFrame([(1,)], "id int")
    none = spark.createDataFrame([(None,)], "id int")
    first, second = M.example_chain(one, none)
    assert [r.id for r in first.collect()] == [1] and [r.id for r in second.collect()] == [1]


def test_green_fee_column_is_used_when_the_raw_table_has_it(spark):
    cols = ("vendorid bigint, ratecodeid bigint, pulocationid bigint, dolocationid bigint, "
            "lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, store_and_fwd_flag string, "
            "passenger_count bigint, trip_distance double, fare_amount double, extra double, mta_tax double, "
            "tip_amount double, tolls_amount double, improvement_surcharge double, total_amount double, "
            "payment_type bigint, trip_type bigint, ehail_fee double")
    row = (1, 1, 1, 1, at("2019-01-15 00:00:00"), at("2019-01-15 00:05:00"), "N", 1, *[1.0] * 8, 1, 1, 2.5)
    late = (*row[:4], at("2019-02-15 00:00:00"), *row[5:])
    raw = spark.createDataFrame([row, late, (None, *row[1:])], cols)
    staged = M.stg_green_tripdata({"green_tripdata": raw})
    assert [float(r.ehail_fee) for r in staged.collect()] == [2.5, 2.5]
    assert M.stg_green_tripdata({"green_tripdata": raw}, target="dev").count() == 1
    assert M.stg_green_tripdata({"green_tripdata": raw.drop("ehail_fee")}).first().ehail_fee is None


def test_monthly_revenue_job_by_arguments(spark, tmp_path):
    from meterline.jobs.monthly_revenue import main
    amounts = ("fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
               "improvement_surcharge double, total_amount double, congestion_surcharge double, "
               "passenger_count int, trip_distance double, PULocationID int")
    for prefix, name in (("lpep", "green"), ("tpep", "yellow")):
        spark.createDataFrame([(at("2020-01-05 10:00:00"), at("2020-01-05 10:09:00"), *[1.5] * 8, 2, 3.0, 7)] * 2,
                              f"{prefix}_pickup_datetime timestamp, {prefix}_dropoff_datetime timestamp, {amounts}"
                              ).write.parquet(str(tmp_path / name))
    for _ in range(2):
        main(["--input_green", str(tmp_path / "green"), "--input_yellow", str(tmp_path / "yellow"),
              "--output", str(tmp_path / "out")])
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.service_type, r.revenue_zone, r.revenue_monthly_total_amount, r.avg_monthly_trip_distance)
                  for r in out.collect()) == [("green", 7, 3.0, 3.0), ("yellow", 7, 3.0, 3.0)]
    assert len(list((tmp_path / "out").glob("part-*.parquet"))) == 1


def test_lines_that_occur_once_are_sorted_by_all_tasks(spark):
    from pyspark.sql import functions as F
    from meterline.catalog.reports import items_per_value
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in items_per_value(spark, "/root/testdata/sf0.001").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) > 100 and max(sizes) < 0.5 * sum(sizes)
