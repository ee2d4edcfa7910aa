"""The star schema from raw tables to marts, checked as whole chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.catalog import query
from meterline.catalog.common import KNOWN_ZONES, days_as_times, over, rounded
from meterline.fixtures import for_hire, raw_service, trips, zones
from meterline.lookups import PAYMENT_DESCRIPTIONS, PAYMENT_NAMES, VENDOR_NAMES, payment_descriptions, payment_names
from meterline.operators import columns as P
from meterline.operators.sets import union_trips
from meterline.plans import models as M
from meterline.session import load_table, stored, work_path
from meterline.sinks.materialize import current


def _values(name: str, columns: str, entries: dict) -> str:
    rows = ", ".join(f"({code}, '{label}')" for code, label in entries.items())
    return f"{name}({columns}) AS (VALUES {rows})"


# One payment code is left out, so that the default label is needed.
_LABELS = {k: v for k, v in PAYMENT_DESCRIPTIONS.items() if k != 3}
_PAYMENTS = _values("payments", "code, description", _LABELS)
_NAMES = _values("payment_names", "code, payment_type_name", PAYMENT_NAMES)
_VENDORS = _values("vendors", "code, vendor_name", VENDOR_NAMES)

_UNIONED = """
raw_unioned AS (
  SELECT vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime, dropoff_datetime,
         store_and_fwd_flag, passenger_count, trip_distance,
         CASE WHEN service_type = 'Green' THEN trip_type ELSE 1 END AS trip_type,
         fare_amount, extra, mta_tax, tip_amount, tolls_amount,
         CASE WHEN service_type = 'Green' THEN NULL ELSE CAST(0 AS DOUBLE) END AS ehail_fee,
         improvement_surcharge, total_amount,
         CASE WHEN source_part % 13 = 0 THEN NULL ELSE payment_type END AS payment_type, service_type
  FROM trips WHERE source_part % 17 <> 0),
unioned AS (SELECT * REPLACE (
    CAST(CAST(trip_distance AS DECIMAL(18,3)) AS DOUBLE) AS trip_distance,
    CAST(CAST(total_amount AS DECIMAL(18,3)) AS DOUBLE) AS total_amount) FROM raw_unioned)"""

_SINGLE = """
single AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY vendor_id, pickup_datetime, pickup_location_id, service_type
      ORDER BY dropoff_datetime, rate_code_id, dropoff_location_id, store_and_fwd_flag, passenger_count,
               trip_distance, trip_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
               improvement_surcharge, total_amount, coalesce(payment_type, 0)) AS rn FROM unioned)
  WHERE rn = 1),
enriched AS (
  SELECT single.* EXCLUDE (payment_type), coalesce(payment_type, 0) AS payment_type,
         coalesce(description, 'Unknown') AS payment_type_description
  FROM single LEFT JOIN payments ON coalesce(payment_type, 0) = code)"""

_FACT = """
fact AS (
  SELECT enriched.*, p.Borough AS pickup_borough, p.Zone AS pickup_zone,
         d.Borough AS dropoff_borough, d.Zone AS dropoff_zone,
         date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes
  FROM enriched LEFT JOIN zones p ON pickup_location_id = p.LocationID
       LEFT JOIN zones d ON dropoff_location_id = d.LocationID)"""


def _tables(spark, folder, only=None, rows=None):
    """Raw tables with gaps: some vendors and some payment codes are missing. ``only`` restricts the trips,
    ``rows`` are trips at hand."""
    out = {}
    for service in ("Green", "Yellow"):
        prefix = {"Green": "lpep", "Yellow": "tpep"}[service]
        part = (trips(spark, folder) if rows is None else rows).filter(F.col("service_type") == service)
        part = part if only is None else part.filter(only)
        shaped = part.select(
            F.when(F.col("source_part") % 17 != 0, F.col("vendor_id")).alias("vendorid"),
            F.col("rate_code_id").alias("ratecodeid"), F.col("pickup_location_id").alias("pulocationid"),
            F.col("dropoff_location_id").alias("dolocationid"),
            F.col("pickup_datetime").alias(f"{prefix}_pickup_datetime"),
            F.col("dropoff_datetime").alias(f"{prefix}_dropoff_datetime"),
            "store_and_fwd_flag", "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax",
            "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "trip_type",
            F.when(F.col("source_part") % 13 != 0, F.col("payment_type")).alias("payment_type"))
        out[f"{service.lower()}_tripdata"] = shaped if service == "Green" else shaped.drop("trip_type")
    out["fhv_tripdata"] = for_hire(spark, folder)
    out["payment_type_lookup"] = payment_descriptions(spark).filter("payment_type <> 3")
    out["taxi_zone_lookup"] = zones(spark, folder, 20)
    return out


_NUMBERS = ["trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
            "improvement_surcharge", "total_amount"]


def _plain(df):
    """Fixed-point numbers as doubles for comparison."""
    return rounded(df, 3, *[c for c in (*_NUMBERS, "ehail_fee") if c in df.columns])


_STAGED_COLUMNS = """vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime,
  dropoff_datetime, store_and_fwd_flag, passenger_count, round(trip_distance, 3) AS trip_distance,
  round(fare_amount, 3) AS fare_amount, round(extra, 3) AS extra, round(mta_tax, 3) AS mta_tax,
  round(tip_amount, 3) AS tip_amount, round(tolls_amount, 3) AS tolls_amount,
  round(improvement_surcharge, 3) AS improvement_surcharge, round(total_amount, 3) AS total_amount,
  CAST(coalesce(payment_type, -1) AS INTEGER) AS payment_type"""


def _filled(df):
    return _plain(df).withColumn("payment_type", F.coalesce("payment_type", F.lit(-1)))


@query("C01 P08 P09 F08", over(f"""
SELECT {_STAGED_COLUMNS}, trip_type, CAST(NULL AS DOUBLE) AS ehail_fee FROM unioned WHERE service_type = 'Green'
""", _UNIONED))
def stg_green_tripdata(spark, folder):
    return _filled(M.stg_green_tripdata(_tables(spark, folder)))


@query("C02 P09 F08", over(f"SELECT {_STAGED_COLUMNS} FROM unioned WHERE service_type = 'Yellow'", _UNIONED))
def stg_yellow_tripdata(spark, folder):
    return _filled(M.stg_yellow_tripdata(_tables(spark, folder)))


@query("C03 P09 P11 F08", over("""
SELECT dispatching_base_num, pickup_location_id, dropoff_location_id, pickup_datetime, dropoff_datetime
FROM trips WHERE source_part % 7 <> 0"""))
def stg_fhv_tripdata(spark, folder):
    return M.stg_fhv_tripdata(_tables(spark, folder))


@query("C04 P07 P08 E01", over(f"""
SELECT {_STAGED_COLUMNS}, trip_type, round(ehail_fee, 3) AS ehail_fee, service_type FROM unioned""", _UNIONED))
def int_trips_unioned(spark, folder):
    return _filled(M.int_trips_unioned(_tables(spark, folder)))


@query("C05 P13 P14 J06 W08", over(f"""
SELECT {_STAGED_COLUMNS}, trip_type, round(ehail_fee, 3) AS ehail_fee, service_type, payment_type_description,
  md5(concat_ws('-', CAST(vendor_id AS VARCHAR), strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'),
                CAST(pickup_location_id AS VARCHAR), service_type)) AS trip_id
FROM enriched""", _UNIONED, _PAYMENTS, _SINGLE))
def int_trips(spark, folder):
    return _plain(M.int_trips(_tables(spark, folder)))


@query("J06 P13", over("""
SELECT payment_type_description, count(*) AS n FROM enriched GROUP BY 1""", _UNIONED, _PAYMENTS, _SINGLE))
def with_payment_description(spark, folder):
    return M.int_trips(_tables(spark, folder)).groupBy("payment_type_description").agg(F.count("*").alias("n"))


@query("C06 P01", "SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone, "
       "CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone "
       "FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20")
def dim_zones(spark, folder):
    return M.dim_zones(_tables(spark, folder))


@query("C07 A12 P12", over("""
SELECT DISTINCT vendor_id, vendor_name FROM unioned LEFT JOIN vendors ON vendor_id = code""", _UNIONED, _VENDORS))
def dim_vendors(spark, folder):
    return M.dim_vendors(_tables(spark, folder))


_TRIP_ID = """md5(concat_ws('-', CAST(vendor_id AS VARCHAR), strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'),
                CAST(pickup_location_id AS VARCHAR), service_type)) AS trip_id"""
_FACT_ROWS = f"""
SELECT {_TRIP_ID}, {_STAGED_COLUMNS}, trip_type, round(ehail_fee, 3) AS ehail_fee, service_type, payment_type_description,
  pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, trip_duration_minutes
FROM fact"""


@query("C08 J05 X05", over(_FACT_ROWS, _UNIONED, _PAYMENTS, _SINGLE, KNOWN_ZONES, _FACT))
def fct_trips(spark, folder):
    return _plain(M.fct_trips(_tables(spark, folder)))


_EARLY = "pickup_datetime < timestamp'1998-07-01' AND source_part % 19 <> 0"
# Trips that were missing from the first load and are no newer than its newest stay out.
_IN_TIME = f"""source_part % 17 <> 0 AND NOT (source_part % 19 = 0 AND pickup_datetime <= (
    SELECT max(pickup_datetime) FROM trips WHERE source_part % 17 <> 0 AND {_EARLY}))"""


@query("C08 M04 M07 Q12", over(_FACT_ROWS, _UNIONED.replace("source_part % 17 <> 0", _IN_TIME), _PAYMENTS, _SINGLE, KNOWN_ZONES, _FACT))
def fct_trips_incremental(spark, folder):
    """Loaded up to a date, then twice with everything there is."""
    target = work_path(spark, "fct-trips")
    raw = stored(trips(spark, folder).drop(
        "congestion_surcharge", "dispatching_base_num", "source_order", "source_line", "source_supplier"), "raw-trips")
    M.load_fct_trips(_tables(spark, folder, _EARLY, raw), target)
    for _ in range(2):
        M.load_fct_trips(_tables(spark, folder, rows=raw), target)
    return _plain(current(spark, target))


@query("C09 A05", over("""
SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
  date_trunc('month', pickup_datetime) AS revenue_month, service_type,
  round(sum(fare_amount), 2) AS revenue_monthly_fare, round(sum(extra), 2) AS revenue_monthly_extra,
  round(sum(mta_tax), 2) AS revenue_monthly_mta_tax, round(sum(tip_amount), 2) AS revenue_monthly_tip_amount,
  round(sum(tolls_amount), 2) AS revenue_monthly_tolls_amount, round(sum(ehail_fee), 2) AS revenue_monthly_ehail_fee,
  round(sum(improvement_surcharge), 2) AS revenue_monthly_improvement_surcharge,
  round(sum(total_amount), 2) AS revenue_monthly_total_amount, count(*) AS total_monthly_trips,
  round(avg(passenger_count), 4) AS avg_monthly_passenger_count,
  round(avg(trip_distance), 4) AS avg_monthly_trip_distance
FROM fact GROUP BY 1, 2, 3""", _UNIONED, _PAYMENTS, _SINGLE, KNOWN_ZONES, _FACT))
def fct_monthly_zone_revenue(spark, folder):
    out = M.fct_monthly_zone_revenue(_tables(spark, folder))
    sums = [c for c in out.columns if c.startswith("revenue_monthly_")]
    return rounded(rounded(out, 2, *sums), 4, "avg_monthly_passenger_count", "avg_monthly_trip_distance")


_START, _END = "1996-03-01", "1998-03-01"
_STAGED = f"""
staged AS (
  SELECT pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, fare_amount, taxi_type,
         payment_type_name
  FROM (SELECT *, lower(service_type) AS taxi_type, row_number() OVER (
          PARTITION BY pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, fare_amount
          ORDER BY lower(service_type), payment_type) AS rn
        FROM trips WHERE pickup_datetime >= TIMESTAMP '{_START}' AND pickup_datetime < TIMESTAMP '{_END}')
       LEFT JOIN payment_names ON payment_type = code
  WHERE rn = 1)"""


def _pipeline_tables(spark, folder):
    both = union_trips(*[P.normalize_trips(raw_service(spark, folder, s, file_names=True), s.lower())
                         for s in ("Green", "Yellow")])
    return {"trips": both, "payment_lookup": payment_names(spark)}


@query("C10 F01 J04 W08 P16", over("SELECT * FROM staged", _NAMES, _STAGED))
def staging_trips(spark, folder):
    return M.staging_trips(_pipeline_tables(spark, folder), _START, _END)


@query("C11 A27", over("""
SELECT date_trunc('day', pickup_datetime) AS trip_date, taxi_type, payment_type_name AS payment_type,
  count(*) AS trip_count, round(sum(fare_amount), 2) AS total_fare, round(avg(fare_amount), 8) AS avg_fare
FROM staged GROUP BY 1, 2, 3""", _NAMES, _STAGED))
def trips_report(spark, folder):
    staged = M.staging_trips(_pipeline_tables(spark, folder), _START, _END)
    out = M.trips_report({"staging_trips": staged}, _START, _END)
    return days_as_times(rounded(rounded(out, 2, "total_fare"), 8, "avg_fare"), "trip_date")


@query("P16 P06", over("""
SELECT pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, fare_amount,
       lower(service_type) AS taxi_type, payment_type FROM trips"""))
def normalize_trips(spark, folder):
    return _pipeline_tables(spark, folder)["trips"]


@query("P12", over("""
SELECT vendor_name, count(*) AS n FROM trips LEFT JOIN vendors ON vendor_id = code GROUP BY 1""", _VENDORS))
def trips_by_vendor_name(spark, folder):
    return trips(spark, folder).groupBy(M.vendor_name().alias("vendor_name")).agg(F.count("*").alias("n"))


@query("C15 E01 F08", "SELECT r_regionkey AS id, r_name FROM region WHERE r_regionkey % 2 <> 0 AND r_regionkey = 1")
def example_chain(spark, folder):
    """Rows with an id stacked on rows without one; only the chosen id is left."""
    region = load_table(spark, folder, "region").withColumn("id", F.col("r_regionkey"))
    odd, even = region.filter("r_regionkey % 2 <> 0"), region.filter("r_regionkey % 2 = 0")
    blank = even.withColumn("id", P.filler(None, "int"))
    return M.example_chain(odd, blank)[1].select("id", "r_name")
