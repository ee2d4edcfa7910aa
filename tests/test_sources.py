import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from conftest import at
from meterline import schemas
from meterline.plans.ingest import ingest_raw
from meterline.sinks import files as S
from meterline.sources import files as R
from meterline.sources import topics
from meterline.sources.nested import read_json_docs


def text_file(path, content):
    path.write_text(content)
    return str(path)


def test_csv_modes(spark, tmp_path, rows):
    path = text_file(tmp_path / "a.csv", "id,at\n1,2024-01-02 03:04:05\n2,\n")
    assert rows(R.read_csv(spark, path)) == [("1", "2024-01-02 03:04:05"), ("2", None)]
    assert rows(R.read_csv(spark, path, "id int, at timestamp")) == [(1, at("2024-01-02 03:04:05")), (2, None)]
    assert R.read_csv(spark, path, infer=True).schema["id"].dataType.simpleString() == "int"


def test_read_any_refuses_other_formats(spark):
    with pytest.raises(ValueError, match="unsupported"):
        R.read_any(spark, "/data/trips.xlsx")


def test_by_name_takes_the_widest_type(spark, tmp_path, rows):
    base = str(tmp_path)
    spark.createDataFrame([(1, 2)], "a int, b int").write.parquet(f"{base}/x")
    spark.createDataFrame([(2.5, "n")], "b double, c string").write.parquet(f"{base}/y")
    spark.createDataFrame([("t", 7)], "c string, a bigint").write.parquet(f"{base}/z")
    out = R.read_parquet(spark, f"{base}/x", f"{base}/y", f"{base}/z", by_name=True)
    assert dict(out.dtypes) == {"a": "bigint", "b": "double", "c": "string"}
    assert rows(out, "a", "b", "c") == sorted([(1, 2.0, None), (None, 2.5, "n"), (7, None, "t")], key=repr)


def test_by_name_over_one_glob(spark, tmp_path, rows):
    for k, (columns, row) in enumerate([("a int, b int, d date", (1, 2, dt.date(2024, 1, 2))), ("a int, b double, c string", (3, 2.5, "n")),
                                        ("a decimal(5,2), b int", (decimal.Decimal("7.25"), 4))]):
        spark.createDataFrame([row], columns).coalesce(1).write.parquet(f"{tmp_path}/part={k}")
    out = R.read_parquet(spark, f"{tmp_path}/part=*", by_name=True)
    assert dict(out.dtypes) == {"a": "decimal(12,2)", "b": "double", "c": "string", "d": "date"}
    assert rows(out, "a", "b", "c") == sorted([(decimal.Decimal("1.00"), 2.0, None), (decimal.Decimal("3.00"), 2.5, "n"),
                                               (decimal.Decimal("7.25"), 4.0, None)], key=repr)
    equal = R.read_parquet(spark, f"{tmp_path}/part=0", f"{tmp_path}/part=0", by_name=True)
    assert equal.count() == 2


def test_months(spark, tmp_path):
    assert R.months_between("2023-11-20", "2024-02-01") == [(2023, 10), (2023, 11), (2024, 0), (2024, 1)]
    with pytest.raises(ValueError, match="at most 12"):
        R.read_months(spark, str(tmp_path), ["yellow"], "2023-01-01", "2024-01-01", max_months=12)
    assert R.read_months(spark, str(tmp_path), ["yellow"], "2023-01-01", "2024-12-01").count() == 0  # no limit by itself
    empty = R.read_months(spark, str(tmp_path), ["yellow"], "2023-01-01", "2023-12-31")
    assert empty.count() == 0
    assert empty.columns == ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
                             "fare_amount", "taxi_type", "payment_type"]


def test_json_docs_and_child_rows(spark, tmp_path, rows):
    path = text_file(tmp_path / "page.json", """{"numFound": 2, "docs": [
        {"key": "/a", "first_publish_year": 1999, "author_name": ["X", "Y"]},
        {"key": "/b", "first_publish_year": 2001}]}""")
    docs = read_json_docs(spark, path, "docs")
    assert rows(docs, "key", "first_publish_year") == [("/a", 1999), ("/b", 2001)]
    from meterline.operators.columns import child_table
    assert rows(child_table(docs, "key", "author_name")) == [("/a", 0, "X"), ("/a", 1, "Y")]


def test_file_name_column(spark, tmp_path, rows):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "out"))
    named = R.with_file_name(spark.read.parquet(str(tmp_path / "out")))
    assert named.filter(F.col("file_name").like("part-%")).count() == 3


def test_topic_options():
    got = topics.topic_source_options("host:9092", "rides", "latest")
    assert got == {"kafka.bootstrap.servers": "host:9092", "subscribe": "rides", "startingOffsets": "latest"}
    assert topics.topic_source_options("h", "t", end="latest")["endingOffsets"] == "latest"
    with pytest.raises(ValueError):
        topics.topic_source_options("h", "t", "middle")


def test_ingest_green_coerces_and_skips_second_run(spark, tmp_path, rows):
    header = ("VendorID,lpep_pickup_datetime,lpep_dropoff_datetime,store_and_fwd_flag,RatecodeID,PULocationID,"
              "DOLocationID,passenger_count,trip_distance,fare_amount,extra,mta_tax,tip_amount,tolls_amount,"
              "improvement_surcharge,total_amount,payment_type,trip_type,congestion_surcharge\n")
    text_file(tmp_path / "g.csv", header +
              "2,2019-01-01 00:10:16,2019-01-01 00:16:32,N,1.0,97,49,bad,.86,6,0.5,0.5,0,0,0.3,7.3,2,1,\n")
    target = str(tmp_path / "typed")
    assert ingest_raw(spark, str(tmp_path / "g.csv"), target, "green")
    assert not ingest_raw(spark, str(tmp_path / "g.csv"), target, "green")
    out = spark.read.parquet(target)
    assert rows(out, "vendorid", "ratecodeid", "passenger_count", "trip_distance", "lpep_pickup_datetime") == [
        (2, 1, None, 0.86, at("2019-01-01 00:10:16"))]
    text_file(tmp_path / "bad.csv", "VendorID,total_amount\n1,2\n")
    with pytest.raises(ValueError, match="required_columns"):
        ingest_raw(spark, str(tmp_path / "bad.csv"), str(tmp_path / "none"), "green")


def test_schemas_parse(spark):
    for name in ("GREEN", "YELLOW", "HIGH_VOLUME", "FOR_HIRE", "RAW_YELLOW", "RAW_GREEN", "RIDE_EVENT", "GREEN_EVENT"):
        assert spark.createDataFrame([], getattr(schemas, name)).columns


def test_time_range_and_day_filters_reach_the_scan(spark, tmp_path):
    from meterline.operators import filters
    path = str(tmp_path / "trips")
    spark.range(100).select(F.timestamp_seconds(F.col("id") * 3600 + 1_600_000_000).alias("pickup_datetime"),
                            "id", (F.col("id") * 2).alias("unused")).write.parquet(path)
    df = spark.read.parquet(path).filter(filters.on_day("pickup_datetime", "2020-09-14")).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "rEqual(pickup_datetime,2020-09-14" in plan and "LessThan(" in plan
    assert "unused" not in plan
    assert df.count() == spark.read.parquet(path).filter(F.to_date("pickup_datetime") == "2020-09-14").count() > 0


def test_partition_range_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.range(240).select(F.timestamp_seconds(F.col("id") * 3600 + 1_600_000_000).alias("ts"),
                                 (F.col("id") % 3).alias("vendor"))
    S.write_partitioned(df, path, "ts", "vendor")
    cut = spark.read.parquet(path).filter(S.partition_range("ts", "2020-09-14", "2020-09-15"))
    assert cut.select("_metadata.file_path").distinct().count() == 2
    assert cut.count() == df.filter("to_date(ts) between '2020-09-14' and '2020-09-15'").count()


def test_write_modes_and_load(spark, tmp_path):
    path = str(tmp_path / "w")
    df = spark.range(40).toDF("id")
    S.write_parquet(df, path, files=4)
    assert R.file_stats(spark.read.parquet(path)).first().files == 4
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        S.write_parquet(df, path)
    S.write_parquet(df, path, mode="overwrite", files=1)
    assert R.file_stats(spark.read.parquet(path)).first().files == 1
    with pytest.raises(ValueError, match="load refused"):
        S.load(df, path, "id int")


def test_json_records_are_strict(spark):
    df = spark.createDataFrame([(1, float("nan"), at("2024-01-02 03:04:05"), None)],
                               "id int, x double, t timestamp, s string")
    assert S.to_json_records(df).first().value == '{"id":1,"x":null,"t":"2024-01-02 03:04:05","s":null}'
    assert '"t":1704164645000' in S.to_json_records(df, ts="millis").first().value


def test_connector_options():
    opts = S.jdbc_options("jdbc:x", "trips", batch=1000, connections=3, user="u")
    assert opts == {"url": "jdbc:x", "dbtable": "trips", "batchsize": "1000", "numPartitions": "3", "user": "u"}
    assert S.topic_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_convert_once(spark, tmp_path):
    source = text_file(tmp_path / "c.csv", "a,b\n1,x\n")
    assert S.convert_once(spark, source, str(tmp_path / "c"), "a int, b string")
    assert not S.convert_once(spark, source, str(tmp_path / "c"), "a int, b string")


def test_month_files_come_from_one_join(spark, monkeypatch):
    from meterline import fixtures
    from meterline.catalog import files
    calls, trips = [], fixtures.trips
    counted = lambda *a: (calls.append(a), trips(*a))[1]
    monkeypatch.setattr(fixtures, "trips", counted)
    monkeypatch.setattr(files, "trips", counted)
    assert files.read_months(spark, "/root/testdata/sf0.001").count() > 0 and len(calls) == 1


def test_text_that_is_no_whole_number_is_not_cast_to_one_first(spark):
    from meterline.operators.columns import coerce
    texts = ["7", " 7\t", "+7", "-7", "7.0", "7.9", "1e3", "", " ", "x", "+", "0x1", "٣", "NaN", "9223372036854775807", "99999999999999999999", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = coerce(df, ints=["t"])
    assert "RLIKE" in out._jdf.queryExecution().optimizedPlan().toString()
    assert [r.t for r in out.collect()] == [7, 7, 7, -7, 7, 7, 1000, None, None, None, None, None, None, None, 9223372036854775807, None, None]
    plain = coerce(df.select(F.lit(2.0).alias("d"), F.lit(3).alias("i")), ints=["d", "i"]).first()
    assert (plain.d, plain.i) == (2, 3)
