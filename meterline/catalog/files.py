"""Sources and file sinks: test tables written out and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from meterline import schemas
from meterline.catalog import query
from meterline.catalog.common import over, rounded
from meterline.fixtures import TIE_BREAK, events, for_hire, raw_service, trips, zones
from meterline.operators import columns as P
from meterline.operators import filters
from meterline.operators.aggregates import count_by
from meterline.operators.sets import union_trips
from meterline.plans import ingest, models, reports
from meterline.session import load_table, stored, work_path
from meterline.sinks import files as S
from meterline.sources import files as R
from meterline.sources import nested

_FHV = """
SELECT dispatching_base_num, pickup_datetime, dropoff_datetime, pickup_location_id AS PULocationID,
       dropoff_location_id AS DOLocationID FROM trips"""
_FHV_SCHEMA = """dispatching_base_num string, pickup_datetime timestamp, dropoff_datetime timestamp,
    PULocationID int, DOLocationID int"""


def _fhv_csv(spark, folder, compression="none"):
    path = work_path(spark, "csv")
    rows = trips(spark, folder).select("dispatching_base_num", "pickup_datetime", "dropoff_datetime",
                                       F.col("pickup_location_id").alias("PULocationID"),
                                       F.col("dropoff_location_id").alias("DOLocationID"))
    rows.write.option("header", True).option("compression", compression).csv(path)
    return path


@query("S01", over(_FHV))
def read_csv(spark, folder):
    return R.read_csv(spark, _fhv_csv(spark, folder), _FHV_SCHEMA)


@query("S02", over("""
SELECT dispatching_base_num, strftime(pickup_datetime, '%Y-%m-%d') AS pickup_day,
       CAST(pickup_location_id AS VARCHAR) AS PULocationID, count(*) AS n FROM trips GROUP BY 1, 2, 3"""))
def read_csv_text(spark, folder):
    rows = R.read_csv(spark, _fhv_csv(spark, folder))
    return count_by(rows, "dispatching_base_num", F.substring("pickup_datetime", 1, 10).alias("pickup_day"),
                    "PULocationID")


@query("S03", over(_FHV))
def read_csv_inferred(spark, folder):
    return R.read_csv(spark, _fhv_csv(spark, folder), infer=True)


@query("S04", over(_FHV))
def read_csv_gzip(spark, folder):
    return R.read_csv(spark, _fhv_csv(spark, folder, "gzip"), _FHV_SCHEMA)


@query("S05 K01 K02", "SELECT * FROM events")
def read_parquet(spark, folder):
    path = work_path(spark, "events")
    S.write_parquet(events(spark, folder), path)
    S.write_parquet(events(spark, folder), path, mode="overwrite")
    return R.read_parquet(spark, path)


@query("S06", over(f"SELECT {', '.join(TIE_BREAK)}, service_type FROM trips"))
def read_parquet_glob(spark, folder):
    base = work_path(spark, "services")
    for service in ("Green", "Yellow"):
        part = trips(spark, folder).filter(F.col("service_type") == service).select(*TIE_BREAK, "service_type")
        S.write_parquet(part, f"{base}/{service.lower()}/all")
    return R.read_parquet(spark, f"{base}/*/*")


@query("S07 E02", """
SELECT event_id, CAST(user_id AS DOUBLE) AS user_id, CASE WHEN event_id % 2 = 0 THEN NULL ELSE value END AS value
FROM events""")
def read_parquet_by_name(spark, folder):
    """Three folders under one glob: columns are missing, in other types and in another order."""
    base, rows = work_path(spark, "drift"), events(spark, folder)
    S.write_parquet(rows.filter("event_id % 4 = 0").select("event_id", "user_id"), f"{base}/a")
    S.write_parquet(rows.filter("event_id % 4 = 2").select(
        F.col("user_id").cast("decimal(18,2)").alias("user_id"), "event_id"), f"{base}/c")
    S.write_parquet(rows.filter("event_id % 2 = 1").select(
        "value", F.col("user_id").cast("double").alias("user_id"), "event_id"), f"{base}/b")
    return R.read_parquet(spark, f"{base}/*", by_name=True)


@query("S08", "SELECT n_nationkey, n_name, 'csv' AS kind FROM nation UNION ALL "
       "SELECT n_nationkey, n_name, 'parquet' FROM nation")
def read_any(spark, folder):
    nation, base = load_table(spark, folder, "nation").select("n_nationkey", "n_name"), work_path(spark, "any")
    nation.write.option("header", True).csv(f"{base}/nation.csv")
    nation.write.parquet(f"{base}/nation.parquet")
    return P.tag(R.read_any(spark, f"{base}/nation.csv"), "kind", "csv").unionByName(
        P.tag(R.read_any(spark, f"{base}/nation.parquet"), "kind", "parquet"))


@query("S09", "SELECT count(DISTINCT event_type) AS types, count(*) AS n FROM events")
def external_table(spark, folder):
    path = work_path(spark, "external")
    S.write_parquet(events(spark, folder), path)
    name = "meterline_" + path.rsplit("-", 1)[1]
    return R.external_table(spark, name, path).agg(F.countDistinct("event_type").alias("types"),
                                                   F.count("*").alias("n"))


@query("S10", over("SELECT LocationID, Borough, Zone, service_zone FROM zones", trips=False, *[
    "zones AS (SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, CASE WHEN n_nationkey % 2 = 0 "
    "THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone FROM nation JOIN region ON n_regionkey = r_regionkey)"]))
def seed(spark, folder):
    path = work_path(spark, "seed")
    zones(spark, folder).write.option("header", True).csv(path)
    R.seed(spark, "meterline_zone_seed", path, schemas.ZONES)
    return spark.table("meterline_zone_seed")


_MONTHS = over("""
SELECT pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, fare_amount,
       lower(service_type) AS taxi_type, payment_type FROM trips
WHERE pickup_datetime >= TIMESTAMP '1996-01-01' AND pickup_datetime < TIMESTAMP '1996-05-01'
  AND NOT (service_type = 'Green' AND month(pickup_datetime) = 2)""")


def _month_files(spark, folder):
    base = work_path(spark, "months")
    # Joined once; every file is cut from the stored rows of the four months.
    few = stored(trips(spark, folder).filter(filters.in_range("pickup_datetime", "1996-01-01", "1996-05-01")), "four-months")
    for service, prefix in (("Green", "lpep"), ("Yellow", "tpep")):
        rows = raw_service(spark, folder, service, file_names=True, rows=few)
        for month in range(1, 5):
            if (service, month) == ("Green", 2):
                continue
            ts = f"{prefix}_pickup_datetime"
            part = rows.filter(filters.in_range(ts, f"1996-{month:02d}-01", f"1996-{month + 1:02d}-01"))
            S.write_parquet(part, f"{base}/{service.lower()}_tripdata_1996-{month:02d}.parquet")
    return base


@query("S11 P16", _MONTHS)
def read_months(spark, folder):
    """Both services over five months; one file and one whole month are missing."""
    return R.read_months(spark, _month_files(spark, folder), ["green", "yellow"], "1996-01-15", "1996-05-20")


@query("S12 P18", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def read_json_docs(spark, folder):
    """Envelopes with a ``docs`` list of whole documents, one per language and slice of ids."""
    path = work_path(spark, "docs")
    docs = load_table(spark, folder, "documents")
    envelopes = docs.groupBy("lang", F.floor(F.col("doc_id") / 50).alias("page")).agg(
        F.collect_list(F.struct("doc_id", "text", "lang", "source", "n_chars")).alias("docs"))
    envelopes.select(F.to_json(F.struct("page", "docs")).alias("value")).write.text(path)
    schema = "page bigint, docs array<struct<doc_id: bigint, text: string, lang: string, source: string, n_chars: bigint>>"
    return nested.read_json_docs(spark, path, "docs", schema, multi_line=False)


@query("F07 A30 S16", over("""
SELECT 'green' AS service, count(*) AS n FROM trips WHERE service_type = 'Green' UNION ALL
SELECT 'yellow', count(*) FROM trips WHERE service_type = 'Yellow'"""))
def count_by_file(spark, folder):
    """Rows per service told apart by the data set's file name alone, in one scan."""
    base = work_path(spark, "named")
    for service in ("green", "yellow"):
        rows = trips(spark, folder).filter(F.lower("service_type") == service).select(*TIE_BREAK)
        rows.write.option("maxRecordsPerFile", 20000).parquet(f"{base}/{service}_tripdata_all.parquet")
    # Spark names the files inside; the data set's name is the folder above them.
    named = R.with_file_name(R.read_parquet(spark, f"{base}/*"), up=1)
    service = reduce(lambda found, s: F.when(filters.file_like(f"{s}_tripdata%"), s).otherwise(found),
                     ("yellow", "green"), F.lit(None))
    return named.groupBy(service.alias("service")).agg(F.count("*").alias("n")).filter("service IS NOT NULL")


@query("S16", "SELECT * FROM events")
def rows_with_file_name(spark, folder):
    """Every row knows the file it was read from."""
    path = work_path(spark, "named-files")
    S.write_parquet(events(spark, folder), path, files=4)
    named = R.with_file_name(R.read_parquet(spark, path))
    return named.filter("file_name LIKE 'part-%.parquet'").drop("file_name")


@query("S17 K03", "SELECT CAST(4 AS BIGINT) AS files, true AS positive, count(*) AS n FROM events")
def file_stats(spark, folder):
    """All events in four files."""
    path = work_path(spark, "four")
    S.write_parquet(events(spark, folder), path, files=4)
    stored = R.read_parquet(spark, path)
    n = stored.agg(F.count("*")).scalar()
    return R.file_stats(stored).select("files", (F.col("mean_mib") > 0).alias("positive"), n.alias("n"))


@query("S18", "SELECT count(*) AS n FROM events")
def register(spark, folder):
    R.register(events(spark, folder), "meterline_events")
    return spark.sql("SELECT count(*) AS n FROM meterline_events")


_MONTHLY_SQL = """
SELECT pickup_location_id AS revenue_zone, date_trunc('month', pickup_datetime) AS revenue_month,
       {service} AS service_type, round(sum(fare_amount), 2) AS revenue_monthly_fare,
       round(sum(extra), 2) AS revenue_monthly_extra, round(sum(mta_tax), 2) AS revenue_monthly_mta_tax,
       round(sum(tip_amount), 2) AS revenue_monthly_tip_amount, round(sum(tolls_amount), 2) AS revenue_monthly_tolls_amount,
       round(sum(improvement_surcharge), 2) AS revenue_monthly_improvement_surcharge,
       round(sum(total_amount), 2) AS revenue_monthly_total_amount,
       round(sum(congestion_surcharge), 2) AS revenue_monthly_congestion_surcharge,
       round(avg(passenger_count), 6) AS avg_monthly_passenger_count,
       round(avg(trip_distance), 6) AS avg_monthly_trip_distance FROM trips GROUP BY 1, 2, 3"""


def _monthly(df):
    """Sums to cents, averages to six digits."""
    sums = [c for c in df.columns if c.startswith("revenue_monthly_")]
    return rounded(rounded(df, 2, *sums), 6, "avg_monthly_passenger_count", "avg_monthly_trip_distance")


@query("K04 C13 A04", over(_MONTHLY_SQL.format(service="lower(service_type)")))
def monthly_revenue_job(spark, folder):
    """Two Parquet inputs to one output file, as the command-line job does it."""
    base = work_path(spark, "job")
    for service in ("Green", "Yellow"):
        S.write_parquet(raw_service(spark, folder, service, file_names=True), f"{base}/{service}")
    models.monthly_revenue_job(spark, f"{base}/Green", f"{base}/Yellow", f"{base}/out")
    return _monthly(R.read_parquet(spark, f"{base}/out"))


@query("K05", over("""
SELECT lower(service_type) AS service, CAST(year(pickup_datetime) AS INTEGER) AS year,
       CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS n FROM trips GROUP BY 1, 2, 3"""))
def write_months(spark, folder):
    path = work_path(spark, "by-month")
    rows = trips(spark, folder).select(F.lower("service_type").alias("service"), "pickup_datetime", "total_amount")
    S.write_months(rows, path, "pickup_datetime", by=("service",))
    return count_by(R.read_parquet(spark, path), "service", "year", "month")


@query("K06 F04", """
SELECT DISTINCT event_type FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-24'""")
def write_partitioned(spark, folder):
    """Distinct types over 15 days; only those days' directories are read."""
    path = work_path(spark, "by-day")
    S.write_partitioned(events(spark, folder), path, "ts", "event_type")
    return (R.read_parquet(spark, path)
            .filter(S.partition_range("ts", "2024-01-10", "2024-01-24")).select("event_type").distinct())


@query("K07 Q08", "SELECT * FROM events")
def load(spark, folder):
    path = work_path(spark, "load")
    wanted = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    rows = events(spark, folder).select("value", "event_id", "props", "ts", "event_type", "user_id")
    S.load(rows, path, wanted)
    S.load(rows, path, wanted)
    return R.read_parquet(spark, path)


@query("K09", "SELECT * FROM events")
def write_table(spark, folder):
    path = work_path(spark, "orc")
    S.write_table(events(spark, folder), "orc", path=path)
    return spark.read.orc(path)


@query("K10 X16 X17", """
SELECT event_id, json_extract_string(props, '$.k') AS k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events""")
def to_json_records(spark, folder):
    rows = events(spark, folder).select("event_id", F.get_json_object("props", "$.k").alias("k"), "ts")
    return S.to_json_records(rows).select(F.from_json("value", "event_id bigint, k string, ts string").alias("r")).select("r.*")


@query("K14 C14 S04 P02 P03 P10 Q09", over("""
SELECT CASE WHEN source_part % 7 <> 0 THEN ' ' || dispatching_base_num || ' ' END AS dispatching_base_num,
       pickup_datetime, dropoff_datetime, CAST(pickup_location_id AS BIGINT) AS pulocationid,
       CAST(dropoff_location_id AS BIGINT) AS dolocationid FROM trips"""))
def ingest_raw(spark, folder):
    """Gzip CSV with variant headers to typed Parquet, twice; the second run does nothing."""
    base = work_path(spark, "ingest")
    rows = for_hire(spark, folder).select(
        "dispatching_base_num", F.col("pickup_datetime").alias("Pickup_Date"),
        F.col("dropoff_datetime").alias("Drop_off datetime"), F.col("pulocationid").alias("PUlocationID"),
        F.col("dolocationid").cast("double").alias("DOlocationID"))
    (rows.write.option("header", True).option("compression", "gzip").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(f"{base}/raw"))
    done = [ingest.ingest_raw(spark, f"{base}/raw", f"{base}/typed", "fhv") for _ in range(2)]
    assert done == [True, False]
    return R.read_parquet(spark, f"{base}/typed")


@query("C14 K14 S04 P02 P03 P10 A04 E01", over(_MONTHLY_SQL.format(service="service_type")))
def ingest_monthly_revenue(spark, folder):
    """Gzip CSV of both services through the raw ingest to the monthly report."""
    base, typed = work_path(spark, "services"), []
    for service, prefix in (("Green", "lpep"), ("Yellow", "tpep")):
        rows = raw_service(spark, folder, service, file_names=True).withColumn("ehail_fee", F.lit(None).cast("string"))
        text = rows.withColumns({c: F.col(c).cast("double") for c in ("VendorID", "passenger_count", "payment_type")})
        text.write.option("header", True).option("compression", "gzip").csv(f"{base}/raw/{service}")
        ingest.ingest_raw(spark, f"{base}/raw/{service}", f"{base}/typed/{service}", service.lower())
        stored = P.rename(R.read_parquet(spark, f"{base}/typed/{service}"), {
            f"{prefix}_pickup_datetime": "pickup_datetime", f"{prefix}_dropoff_datetime": "dropoff_datetime"})
        typed.append(P.tag(stored, "service_type", service))
    shared = P.common_columns(*typed)
    trips_ = union_trips(*[t.select(*shared) for t in typed])
    out = _monthly(reports.monthly_zone_revenue(trips_, zone="pulocationid"))
    return out.withColumn("revenue_zone", F.col("revenue_zone").cast("int"))
