"""Column transforms and scalar functions over trips and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline import schemas
from meterline.catalog import query
from meterline.catalog.common import days_as_times, over
from meterline.fixtures import TIE_BREAK, events, raw_service, trips
from meterline.functions import scalars as X
from meterline.functions.scoring import predict_duration
from meterline.lookups import FOR_HIRE_ALIASES
from meterline.operators import columns as P
from meterline.operators import filters
from meterline.operators.quality import contract, required_columns, run_checks
from meterline.operators.sets import concat_frames
from meterline.session import load_table

_TIES = ", ".join(TIE_BREAK)


@query("P02 P03", "SELECT event_id, ts AS dropoff_datetime, ts AS drop_off_datetime, value AS fare_amount FROM events")
def headers_and_aliases(spark, folder):
    messy = events(spark, folder).select("event_id", F.col("ts").alias(" Drop_off DateTime "),
                                         F.col("value").alias("Fare Amount"))
    return P.apply_aliases(P.normalize_headers(messy), FOR_HIRE_ALIASES)


@query("P05 P04", over("SELECT vendor_id AS VendorID, trip_distance, total_amount FROM trips WHERE service_type = 'Green'"))
def common_columns(spark, folder):
    green = raw_service(spark, folder, "Green", file_names=True)
    yellow = raw_service(spark, folder, "Yellow", file_names=True).select("total_amount", "trip_distance", "VendorID")
    return green.select(*P.common_columns(green, yellow))


@query("P06", "SELECT event_id, value FROM events")
def select_existing(spark, folder):
    return P.select_existing(events(spark, folder), ["event_id", "fare", "value"])


@query("P09", "SELECT event_id, CAST(user_id AS INTEGER) AS user_id, CAST(CAST(value AS DECIMAL(18,3)) AS VARCHAR) AS value, "
       "CAST(CAST(value AS DECIMAL(18,1)) AS VARCHAR) AS coarse FROM events")
def cast_strict(spark, folder):
    """The decimals as text, digit by digit."""
    rows = events(spark, folder).withColumn("coarse", F.col("value"))
    typed = P.cast_strict(rows, {"user_id": "int", "value": "decimal(18,3)", "coarse": "decimal(18,1)"})
    return typed.select("event_id", "user_id", F.col("value").cast("string").alias("value"), F.col("coarse").cast("string").alias("coarse"))


@query("P10 X18", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS user_id,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('second', ts) END AS ts FROM events""")
def coerce(spark, folder):
    """Text fields, some of them spoiled, to nullable numbers and times."""
    spoil = lambda n, good, bad: F.when(F.col("event_id") % n == 0, F.lit(bad)).otherwise(good)
    text = events(spark, folder).select(
        "event_id", spoil(3, F.concat(F.col("user_id").cast("string"), F.lit(".0")), "n/a").alias("user_id"),
        spoil(5, F.col("value").cast("string"), "?").alias("value"),
        spoil(7, X.format_ts("ts"), "yesterday").alias("ts"))
    return (P.coerce(text, ints=["user_id"], floats=["value"], timestamps=["ts"])
            .withColumn("user_id", F.col("user_id").cast("double")))


@query("P14", over(f"""
SELECT {_TIES}, md5(concat_ws('-', CASE WHEN source_part % 13 = 0 THEN '_null_' ELSE CAST(vendor_id AS VARCHAR) END,
  strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'), service_type)) AS trip_id FROM trips"""))
def surrogate_key(spark, folder):
    rows = trips(spark, folder).withColumn("vendor_id", F.when(F.col("source_part") % 13 != 0, F.col("vendor_id")))
    return rows.select(*TIE_BREAK, P.surrogate_key("vendor_id", "pickup_datetime", "service_type").alias("trip_id"))


@query("E02 P07 P08", """
SELECT n_nationkey AS id, n_name AS name, NULL AS region, 'nation' AS kind FROM nation UNION ALL
SELECT r_regionkey, NULL, r_name, 'region' FROM region""")
def concat_frames_query(spark, folder):
    nation = load_table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    region = load_table(spark, folder, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("region"))
    return concat_frames(P.tag(nation, "kind", "nation"), P.tag(region, "kind", "region"))


@query("X01 X02 X03 X07", """
SELECT event_id, date_trunc('month', ts) AS month, date_trunc('hour', ts) AS hour, date_trunc('day', ts) AS day,
       CAST(year(ts) AS INTEGER) AS year FROM events""")
def time_parts(spark, folder):
    out = events(spark, folder).select("event_id", X.trunc_to("ts", "month").alias("month"),
                                       X.trunc_to("ts", "hour").alias("hour"), X.day_of("ts").alias("day"),
                                       X.year_of("ts").alias("year"))
    return days_as_times(out, "day")


@query("X04 X05 X06", over(f"""
SELECT {_TIES}, date_diff('minute', pickup_datetime, dropoff_datetime) AS minutes,
  date_diff('second', pickup_datetime, dropoff_datetime) AS seconds,
  CAST(epoch(pickup_datetime) AS BIGINT) AS started FROM trips"""))
def durations(spark, folder):
    return trips(spark, folder).select(
        *TIE_BREAK, X.minutes_between("pickup_datetime", "dropoff_datetime").alias("minutes"),
        X.seconds_between("pickup_datetime", "dropoff_datetime").alias("seconds"),
        X.to_seconds("pickup_datetime").alias("started"))


@query("X08 X09 X10 X11", """
SELECT event_id, date_trunc('second', ts) AS parsed, date_trunc('millisecond', ts) AS from_ms, epoch_us(ts) // 1000 AS ms,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM events""")
def time_conversions(spark, folder):
    return events(spark, folder).select(
        "event_id", X.parse_ts(X.format_ts("ts")).alias("parsed"), X.from_millis(X.to_millis("ts")).alias("from_ms"),
        X.to_millis("ts").alias("ms"), X.format_ts("ts").alias("text"))


@query("X12 X13 X14 X15 P13", """
SELECT doc_id, lower(lang) || '/' || source AS label, CASE WHEN doc_id % 4 <> 0 THEN text || '|' || lang END AS k,
       replace(text, ' the ', ' ') AS short, CASE WHEN doc_id % 4 <> 0 THEN text ELSE 'none' END AS filled,
       trim(' ' || text || ' ', ' ') AS trimmed
FROM documents""")
def text_functions(spark, folder):
    docs = load_table(spark, folder, "documents")
    some = F.when(F.col("doc_id") % 4 != 0, F.col("text"))
    return docs.select(
        "doc_id", F.concat(F.lower("lang"), F.lit("/"), "source").alias("label"),
        X.concat_key(some, "lang").alias("k"), F.replace("text", F.lit(" the "), F.lit(" ")).alias("short"),
        F.coalesce(some, F.lit("none")).alias("filled"),
        F.trim(F.concat(F.lit(" "), "text", F.lit(" "))).alias("trimmed"))


@query("X16", """
SELECT event_id, CASE WHEN event_id % 6 IN (0, 1) THEN NULL ELSE value END AS value FROM events""")
def finite_or_null(spark, folder):
    number = F.col("event_id") % 6
    odd = F.when(number == 0, F.lit(float("nan"))).when(number == 1, F.lit(float("-inf"))).otherwise(F.col("value"))
    return events(spark, folder).select("event_id", X.finite_or_null(odd).alias("value"))


@query("X17", "SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events")
def json_decode(spark, folder):
    return events(spark, folder).select("event_id", F.from_json("props", "k double")["k"].alias("k"))


@query("F07", "SELECT doc_id, text FROM documents WHERE text LIKE 'A% the %'")
def like_prefix(spark, folder):
    return load_table(spark, folder, "documents").filter(filters.file_like("A% the %", "text")).select("doc_id", "text")


@query("N02 N03", over(f"SELECT {_TIES}, trip_distance, trip_distance * 5 AS predicted_duration FROM trips"))
def predict_duration_query(spark, folder):
    return predict_duration(trips(spark, folder).select(*TIE_BREAK, "trip_distance"))


@query("Q08 Q09 P16", over("""
SELECT pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, fare_amount,
       'green' AS taxi_type, payment_type FROM trips WHERE service_type = 'Green'"""))
def contracted_trips(spark, folder):
    """Rows leave only when names and types equal the declared ones."""
    raw = raw_service(spark, folder, "Green", file_names=True)
    run_checks(raw, [required_columns(["VendorID", "PULocationID", "total_amount"])]).raise_on_failure()
    out = P.normalize_trips(raw, "green")
    run_checks(out, [contract(schemas.NORMALISED_TRIPS)]).raise_on_failure()
    return out
