"""Counts, sums and top-k reports over trips, with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.catalog import query
from meterline.catalog.common import KNOWN_ZONES, ZONES, days_as_times, over, rounded
from meterline.fixtures import events, for_hire, raw_service, trips, zones
from meterline.functions import scalars as X
from meterline.operators import aggregates as A
from meterline.operators import columns as P
from meterline.operators import filters
from meterline.operators.joins import lookup_join
from meterline.operators.sets import union_trips
from meterline.plans import reports as R
from meterline.session import load_table
from meterline.sources.files import register

SUMS = [f"revenue_monthly_{c}" for c in ("fare", *R.MONTHLY_SUMS[1:])]
AVERAGES = ["avg_monthly_passenger_count", "avg_monthly_trip_distance"]

_MONTHLY_SQL = """
SELECT pickup_location_id AS revenue_zone, date_trunc('month', pickup_datetime) AS revenue_month,
       lower(service_type) AS service_type,
       round(sum(fare_amount), 2) AS revenue_monthly_fare,
       round(sum(extra), 2) AS revenue_monthly_extra,
       round(sum(mta_tax), 2) AS revenue_monthly_mta_tax,
       round(sum(tip_amount), 2) AS revenue_monthly_tip_amount,
       round(sum(tolls_amount), 2) AS revenue_monthly_tolls_amount,
       round(sum(improvement_surcharge), 2) AS revenue_monthly_improvement_surcharge,
       round(sum(total_amount), 2) AS revenue_monthly_total_amount,
       round(sum(congestion_surcharge), 2) AS revenue_monthly_congestion_surcharge,
       round(avg(passenger_count), 6) AS avg_monthly_passenger_count,
       round(avg(trip_distance), 6) AS avg_monthly_trip_distance
FROM trips GROUP BY 1, 2, 3
"""


def _both_services(spark, folder):
    """Each service from its raw table, renamed, projected, tagged, then unioned."""
    parts = []
    for service, prefix in (("Green", "lpep"), ("Yellow", "tpep")):
        raw = P.rename(raw_service(spark, folder, service, file_names=True), {
            f"{prefix}_pickup_datetime": "pickup_datetime",
            f"{prefix}_dropoff_datetime": "dropoff_datetime"})
        parts.append(raw)
    shared = P.common_columns(*parts)
    return union_trips(*[P.tag(raw.select(*shared), "service_type", name)
                         for raw, name in zip(parts, ("green", "yellow"))])


@query("A04 C13 P01 P04 P05 P07 E01 X01", over(_MONTHLY_SQL))
def monthly_zone_revenue(spark, folder):
    out = R.monthly_zone_revenue(_both_services(spark, folder), zone="PULocationID")
    return rounded(rounded(out, 2, *SUMS), 6, *AVERAGES)


@query("A03", over("SELECT lower(service_type) AS service_type, count(*) AS n FROM trips GROUP BY 1"))
def count_by_service(spark, folder):
    return A.count_by(_both_services(spark, folder), "service_type")


@query("A01", "SELECT count(*) AS n FROM lineitem")
def count_all(spark, folder):
    return load_table(spark, folder, "lineitem").agg(F.count("*").alias("n"))


@query("A02 F01 F05", over("""
SELECT count(*) AS trip_count FROM trips
WHERE pickup_datetime >= TIMESTAMP '1996-11-01' AND pickup_datetime < TIMESTAMP '1996-12-01'
  AND trip_distance <= 10"""))
def short_trip_count(spark, folder):
    return R.short_trip_count(trips(spark, folder), "1996-11-01", "1996-12-01", 10)


@query("A02 F05", over("SELECT count(*) AS n FROM trips WHERE tip_amount = 0"))
def zero_tip_count(spark, folder):
    return trips(spark, folder).filter(F.col("tip_amount") == 0).agg(F.count("*").alias("n"))


@query("A02 F05", over("SELECT count(*) AS n FROM trips WHERE fare_amount = 0"))
def zero_fare_count(spark, folder):
    return trips(spark, folder).filter(F.col("fare_amount") == 0).agg(F.count("*").alias("n"))


@query("E01 P01 P07", over("""
SELECT vendor_id AS "VendorID", pickup_datetime, pickup_location_id AS "PULocationID", total_amount,
       lower(service_type) AS service_type FROM trips"""), name="union_trips")
def union_trips_query(spark, folder):
    return _both_services(spark, folder).select("VendorID", "pickup_datetime", "PULocationID", "total_amount",
                                                "service_type")


@query("A05", over("""
SELECT coalesce(Zone, 'Unknown Zone') AS pickup_zone,
       date_trunc('month', pickup_datetime) AS revenue_month, service_type,
       round(sum(fare_amount), 2) AS revenue_monthly_fare,
       round(sum(extra), 2) AS revenue_monthly_extra,
       round(sum(mta_tax), 2) AS revenue_monthly_mta_tax,
       round(sum(tip_amount), 2) AS revenue_monthly_tip_amount,
       round(sum(tolls_amount), 2) AS revenue_monthly_tolls_amount,
       CAST(sum(0) AS DOUBLE) AS revenue_monthly_ehail_fee,
       round(sum(improvement_surcharge), 2) AS revenue_monthly_improvement_surcharge,
       round(sum(total_amount), 2) AS revenue_monthly_total_amount,
       count(*) AS total_monthly_trips,
       round(avg(passenger_count), 6) AS avg_monthly_passenger_count,
       round(avg(trip_distance), 6) AS avg_monthly_trip_distance
FROM trips LEFT JOIN zones ON pickup_location_id = LocationID GROUP BY 1, 2, 3""", KNOWN_ZONES))
def monthly_zone_name_revenue(spark, folder):
    named = lookup_join(trips(spark, folder), zones(spark, folder, 20), "pickup_location_id",
                        "LocationID", {"Zone": "pickup_zone"})
    out = R.monthly_zone_name_revenue(named.withColumn("ehail_fee", P.filler(0, "double")))
    sums = [c for c in out.columns if c.startswith("revenue_monthly_")]
    return rounded(rounded(out, 2, *sums), 6, *AVERAGES)


_HOURLY_SQL = """
SELECT date_trunc('hour', pickup_datetime) AS hour, pickup_location_id AS zone,
       round(sum(total_amount), 2) AS {amount}, count(*) AS {number}
FROM trips WHERE pickup_datetime >= TIMESTAMP '1996-01-01'{more} GROUP BY 1, 2
"""


@query("A06 F02 X01", over(_HOURLY_SQL.format(amount="amount", number="number_records",
                                              more=" AND service_type = 'Green'")))
def hourly_zone_revenue(spark, folder):
    green = trips(spark, folder).filter(F.col("service_type") == "Green")
    return rounded(R.hourly_zone_revenue(green, "1996-01-01"), 2, "amount")


@query("A28 N01 X02", over(_HOURLY_SQL.format(amount="revenue", number='"count"', more="")))
def hourly_zone_revenue_rdd(spark, folder):
    """The keyed reduce of (amount, count) pairs as an ordinary aggregation."""
    out = R.hourly_zone_revenue(trips(spark, folder), "1996-01-01", amount="revenue", number="count")
    return rounded(out, 2, "revenue")


_GREEN_YELLOW = """
hourly AS (
  SELECT date_trunc('hour', pickup_datetime) AS hour, pickup_location_id AS zone, service_type,
         round(sum(total_amount), 2) AS amount, CAST(count(*) AS DOUBLE) AS number_records
  FROM trips WHERE pickup_datetime >= TIMESTAMP '1996-01-01' GROUP BY 1, 2, 3),
both_services AS (
  SELECT * FROM (SELECT hour, zone, amount AS green_amount, number_records AS green_number_records
                 FROM hourly WHERE service_type = 'Green')
  FULL JOIN (SELECT hour, zone, amount AS yellow_amount, number_records AS yellow_number_records
             FROM hourly WHERE service_type = 'Yellow') USING (hour, zone))"""


def _raw_pair(spark, folder):
    return [raw_service(spark, folder, s, file_names=True) for s in ("Green", "Yellow")]


@query("J07", over("SELECT * FROM both_services", _GREEN_YELLOW))
def hourly_green_yellow(spark, folder):
    green, yellow = _raw_pair(spark, folder)
    out = R.hourly_green_yellow(
        R.hourly_zone_revenue(green, "1996-01-01", ts="lpep_pickup_datetime", zone="PULocationID"),
        R.hourly_zone_revenue(yellow, "1996-01-01", ts="tpep_pickup_datetime", zone="PULocationID"))
    return rounded(out, 2, "green_amount", "yellow_amount", "green_number_records", "yellow_number_records")


@query("J03 P15", over("""
SELECT hour, amount, number_records, Borough, Zone, service_zone
FROM (SELECT hour, zone AS zone_id, sum(amount) AS amount, CAST(sum(number_records) AS BIGINT) AS number_records
      FROM hourly WHERE service_type = 'Green' GROUP BY 1, 2)
JOIN zones ON zone_id = LocationID""", _GREEN_YELLOW, KNOWN_ZONES))
def revenue_with_zones(spark, folder):
    """Zone ids arrive as text, as from a reader without types."""
    hourly = R.hourly_zone_revenue(trips(spark, folder).filter("service_type = 'Green'"), "1996-01-01")
    text_keys = hourly.withColumn("zone", F.col("zone").cast("string"))
    return rounded(R.revenue_with_zones(text_keys, zones(spark, folder, 20)), 2, "amount")


@query("C12 A06 J07 J03", over("""
SELECT hour, green_amount, green_number_records, yellow_amount, yellow_number_records,
       Borough, zones.Zone AS Zone, service_zone
FROM both_services JOIN zones ON both_services.zone = LocationID""", _GREEN_YELLOW, KNOWN_ZONES))
def zone_revenue_report(spark, folder):
    out = R.zone_revenue_report(*_raw_pair(spark, folder), zones(spark, folder, 20), "1996-01-01")
    return rounded(out, 2, "green_amount", "yellow_amount", "green_number_records", "yellow_number_records")


@query("A07 O01 X03", over("""
SELECT date_trunc('day', pickup_datetime) AS pickup_day, max(trip_distance) AS max_trip_distance
FROM trips WHERE trip_distance < 50 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"""))
def longest_trip_per_day(spark, folder):
    return days_as_times(R.longest_trip_per_day(trips(spark, folder), 50, 1), "pickup_day")


@query("J01 F03 O01", over("""
SELECT Zone AS pickup_zone, round(sum(total_amount), 2) AS total_amount_sum
FROM trips JOIN zones ON pickup_location_id = LocationID
WHERE CAST(pickup_datetime AS DATE) = DATE '1996-11-18' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""", ZONES))
def zone_revenue_on_day(spark, folder):
    return rounded(R.zone_revenue_on_day(trips(spark, folder), zones(spark, folder), "1996-11-18", 5),
                   2, "total_amount_sum")


@query("J02 F04 F06", over("""
SELECT d.Zone AS dropoff_zone, max(tip_amount) AS total_tip_amount
FROM trips JOIN zones p ON pickup_location_id = p.LocationID JOIN zones d ON dropoff_location_id = d.LocationID
WHERE p.Zone = 'NATION_7' AND CAST(pickup_datetime AS DATE) BETWEEN DATE '1996-11-01' AND DATE '1997-02-28'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""", ZONES))
def max_tip_by_dropoff(spark, folder):
    return R.max_tip_by_dropoff(trips(spark, folder), zones(spark, folder), "NATION_7",
                                "1996-11-01", "1997-02-28", 3)


@query("J04 O02", over("""
SELECT Zone, count(*) AS n FROM trips LEFT JOIN zones ON pickup_location_id = LocationID GROUP BY 1
""", KNOWN_ZONES))
def pickup_counts(spark, folder):
    return R.pickup_counts(trips(spark, folder), zones(spark, folder, 20)).orderBy("n", "Zone")


@query("A17 O02", over("""
SELECT Zone, count(*) AS n FROM trips LEFT JOIN zones ON pickup_location_id = LocationID
GROUP BY 1 ORDER BY 2, 1 NULLS LAST LIMIT 3""", KNOWN_ZONES))
def least_frequent_zone(spark, folder):
    return R.least_frequent_zone(trips(spark, folder), zones(spark, folder, 20), 3)


@query("A16 J05 X12", over("""
SELECT p.Zone || ' / ' || d.Zone AS pu_do_pair, count(*) AS n
FROM trips LEFT JOIN zones p ON pickup_location_id = p.LocationID
     LEFT JOIN zones d ON dropoff_location_id = d.LocationID
GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 5""", KNOWN_ZONES))
def top_zone_pairs(spark, folder):
    return R.top_zone_pairs(trips(spark, folder), zones(spark, folder, 20), 5)


_DURATION_SQL = """
SELECT date_trunc('day', pickup_datetime) AS pickup_date,
       max(epoch(dropoff_datetime) - epoch(pickup_datetime)) AS seconds FROM trips GROUP BY 1"""


@query("A08 X04 O01", over(f"""
SELECT pickup_date, CAST(seconds AS BIGINT) AS duration FROM ({_DURATION_SQL}) ORDER BY 2 DESC, 1 LIMIT 5"""))
def max_duration_per_day(spark, folder):
    return days_as_times(R.max_duration_per_day(trips(spark, folder), 5), "pickup_date")


@query("A09 X19 O03", over(f"""
SELECT pickup_date, round(seconds / 60.0, 6) AS duration FROM ({_DURATION_SQL}) ORDER BY 2 DESC, 1 LIMIT 10"""))
def max_duration_minutes_per_day(spark, folder):
    out = R.max_duration_per_day(trips(spark, folder), 10, per=60)
    return days_as_times(rounded(out, 6, "duration"), "pickup_date")


@query("A10 X04", over(f"SELECT round(max(seconds) / 3600.0, 6) AS max_hours FROM ({_DURATION_SQL})"))
def max_duration_hours(spark, folder):
    return rounded(R.max_duration_hours(trips(spark, folder)), 6, "max_hours")


@query("A11", over("SELECT count(DISTINCT pickup_location_id) AS zones FROM trips"))
def distinct_pickup_zones(spark, folder):
    return trips(spark, folder).agg(F.countDistinct("pickup_location_id").alias("zones"))


@query("A12 F04", over("""
SELECT DISTINCT vendor_id FROM trips
WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-15'"""))
def distinct_vendors(spark, folder):
    return (trips(spark, folder).filter(filters.between_days("pickup_datetime", "1996-03-01", "1996-03-15"))
            .select("vendor_id").distinct())


_API_SQL = """
api AS (
  SELECT pickup_datetime AS trip_pickup_date_time, dropoff_datetime AS trip_dropoff_date_time,
         pickup_location_id AS start_lat,
         CASE WHEN source_part % 11 <> 0 THEN dropoff_location_id END AS start_lon,
         round(fare_amount / 1000) AS fare_amt, tip_amount AS tip_amt,
         CASE WHEN payment_type = 1 THEN 'Credit' WHEN payment_type = 2 AND source_part % 3 = 0 THEN 'CASH'
              WHEN payment_type = 2 THEN 'Cash' ELSE 'Dispute' END AS payment_type
  FROM trips)"""


def _api_trips(spark, folder):
    """Trips as an API hands them out: text payment labels in mixed case."""
    pay, part = F.col("payment_type"), F.col("source_part")
    return trips(spark, folder).select(
        F.col("pickup_datetime").alias("trip_pickup_date_time"),
        F.col("dropoff_datetime").alias("trip_dropoff_date_time"),
        F.col("pickup_location_id").alias("start_lat"),
        F.when(part % 11 != 0, F.col("dropoff_location_id")).alias("start_lon"),
        F.round(F.col("fare_amount") / 1000).alias("fare_amt"), F.col("tip_amount").alias("tip_amt"),
        F.when(pay == 1, "Credit").when((pay == 2) & (part % 3 == 0), "CASH").when(pay == 2, "Cash")
        .otherwise("Dispute").alias("payment_type"))


@query("A13 Q10 X13", over("""
SELECT count(*) AS total_rows, count(DISTINCT k) AS distinct_rows, count(*) - count(DISTINCT k) AS duplicate_rows
FROM (SELECT CASE WHEN trip_pickup_date_time IS NOT NULL AND trip_dropoff_date_time IS NOT NULL
             THEN CAST(start_lat AS VARCHAR) || '|' || coalesce(CAST(start_lon AS VARCHAR), '') || '|'
                  || CAST(epoch_us(trip_pickup_date_time) AS VARCHAR) || '|'
                  || CAST(epoch_us(trip_dropoff_date_time) AS VARCHAR) || '|' || CAST(fare_amt AS VARCHAR) END AS k
      FROM api)""", _API_SQL))
def duplicate_report(spark, folder):
    return A.duplicate_report(_api_trips(spark, folder),
                              ["trip_pickup_date_time", "trip_dropoff_date_time"],
                              ["start_lat", "start_lon", "fare_amt"])


@query("A14", over("""
SELECT count(*) AS pairs FROM (SELECT DISTINCT trip_pickup_date_time, fare_amt FROM api
WHERE trip_pickup_date_time IS NOT NULL AND fare_amt IS NOT NULL)""", _API_SQL))
def distinct_pickup_fare(spark, folder):
    return A.distinct_pairs(_api_trips(spark, folder), "trip_pickup_date_time", "fare_amt", "pairs")


@query("A15 O01", over("""
SELECT dispatching_base_num, count(*) AS n FROM trips GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""))
def top_dispatch_bases(spark, folder):
    return A.most_frequent(trips(spark, folder), ["dispatching_base_num"], 5)


@query("A18", over("""
SELECT min(trip_pickup_date_time) AS first_value, max(trip_pickup_date_time) AS last_value, count(*) AS n
FROM api""", _API_SQL))
def date_span(spark, folder):
    return A.span(_api_trips(spark, folder), "trip_pickup_date_time")


@query("A19", over("""
SELECT payment_type, count(*) AS n,
       round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share
FROM api GROUP BY 1""", _API_SQL))
def payment_share(spark, folder):
    counts = A.count_by(_api_trips(spark, folder), "payment_type")
    return rounded(A.share_of_total(counts, "n"), 6, "share")


@query("A20", over("SELECT round(sum(tip_amt), 2) AS total_tips FROM api", _API_SQL))
def total_tips(spark, folder):
    return rounded(_api_trips(spark, folder).agg(F.sum("tip_amt").alias("total_tips")), 2, "total_tips")


@query("F09 X14", over("SELECT count(*) AS n FROM api WHERE lower(payment_type) = 'cash'", _API_SQL))
def cash_trips(spark, folder):
    return _api_trips(spark, folder).filter(filters.same_text("payment_type", "Cash")).agg(F.count("*").alias("n"))


@query("A21", over("SELECT payment_type, count(*) AS n FROM api GROUP BY 1", _API_SQL))
def trips_by_payment(spark, folder):
    return A.count_by(_api_trips(spark, folder), "payment_type").orderBy(F.desc("n"))


@query("A22 X03", over("""
SELECT date_trunc('day', trip_pickup_date_time) AS pickup_date, count(*) AS trip_count FROM api GROUP BY 1""", _API_SQL))
def trips_per_day(spark, folder):
    out = A.count_by(_api_trips(spark, folder), X.day_of("trip_pickup_date_time").alias("pickup_date"),
                     name="trip_count").orderBy("pickup_date")
    return days_as_times(out, "pickup_date")


@query("A23", over("SELECT payment_type, round(sum(tip_amt), 2) AS tips FROM api GROUP BY 1", _API_SQL))
def tips_by_payment(spark, folder):
    out = _api_trips(spark, folder).groupBy("payment_type").agg(F.sum("tip_amt").alias("tips"))
    return rounded(out, 2, "tips").orderBy(F.desc("tips"))


@query("A24 P18", """
SELECT value, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents) GROUP BY 1""")
def items_per_value(spark, folder):
    """Lines by count. Most occur once, and a hash deals those of one count over the tasks of the sort."""
    docs = load_table(spark, folder, "documents").withColumn("lines", F.split("text", "\n"))
    return A.count_by(P.child_table(docs, "doc_id", "lines"), "value").orderBy(F.desc("n"), F.xxhash64("value"))


@query("P18", """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS "index", lines[i] AS value
FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""")
def child_table(spark, folder):
    docs = load_table(spark, folder, "documents").withColumn("lines", F.split("text", "\n"))
    return P.child_table(docs, "doc_id", "lines")


@query("A25 O02", "SELECT year(ts) AS year, month(ts) AS month, count(*) AS n FROM events GROUP BY 1, 2")
def items_per_year(spark, folder):
    return A.count_by(events(spark, folder), F.year("ts").alias("year"), F.month("ts").alias("month")).orderBy(
        "year", "month")


@query("A26 F12 X07", over("""
SELECT CAST(sum(n) AS BIGINT) AS total_trips FROM (
  SELECT date_trunc('month', pickup_datetime) AS m, service_type, count(*) AS n FROM trips GROUP BY 1, 2)
WHERE m = TIMESTAMP '1996-10-01' AND service_type = 'Green'"""))
def mart_trip_total(spark, folder):
    mart = trips(spark, folder).groupBy(X.trunc_to("pickup_datetime", "month").alias("m"), "service_type").agg(
        F.count("*").alias("n"))
    return (mart.filter((F.col("m") == F.lit("1996-10-01").cast("timestamp")) & (F.col("service_type") == "Green"))
            .agg(F.sum("n").alias("total_trips")))


@query("A26 F12 X07 O01", over("""
SELECT pickup_zone, revenue_month, revenue FROM (
  SELECT Zone AS pickup_zone, date_trunc('month', pickup_datetime) AS revenue_month,
         round(sum(total_amount), 2) AS revenue
  FROM trips JOIN zones ON pickup_location_id = LocationID WHERE service_type = 'Green' GROUP BY 1, 2)
WHERE year(revenue_month) = 1998 ORDER BY revenue DESC, pickup_zone LIMIT 1""", ZONES))
def mart_best_zone(spark, folder):
    named = lookup_join(trips(spark, folder).filter("service_type = 'Green'"), zones(spark, folder),
                        "pickup_location_id", "LocationID", {"Zone": "pickup_zone"}, "inner")
    mart = named.groupBy("pickup_zone", X.trunc_to("pickup_datetime", "month").alias("revenue_month")).agg(
        F.sum("total_amount").alias("revenue"))
    best = A.top_k(mart.filter(X.year_of("revenue_month") == 1998), [F.desc("revenue"), F.col("pickup_zone")], 1)
    return rounded(best, 2, "revenue")


@query("A29 X18", "SELECT count(*) AS total_rows, count(*) FILTER (value > 5) AS rows_over FROM events")
def count_over_threshold(spark, folder):
    text = events(spark, folder).withColumn("value", X.lenient_double(F.col("value").cast("string")))
    return A.count_over_threshold(text, "value", 5.0)


@query("F14", over("SELECT count(*) AS n FROM trips WHERE pickup_datetime >= TIMESTAMP '1996-01-01'"))
def since_start(spark, folder):
    return trips(spark, folder).filter(filters.since("pickup_datetime", "1996-01-01")).agg(F.count("*").alias("n"))


@query("F03", over("""
SELECT count(*) AS n FROM trips WHERE CAST(pickup_datetime AS DATE) = DATE '1997-02-15'"""))
def trips_on_day(spark, folder):
    return trips(spark, folder).filter(filters.on_day("pickup_datetime", "1997-02-15")).agg(F.count("*").alias("n"))


@query("F08 P11", over("""
SELECT count(*) AS n FROM trips WHERE source_part % 7 <> 0"""))
def known_base_count(spark, folder):
    return filters.not_null(for_hire(spark, folder), "dispatching_base_num").agg(F.count("*").alias("n"))


@query("F10", over("""
SELECT service_type, count(*) AS n FROM trips
WHERE pickup_datetime >= TIMESTAMP '1999-01-01' AND pickup_datetime < TIMESTAMP '1999-02-01' GROUP BY 1"""))
def dev_sample(spark, folder):
    return A.count_by(filters.dev_sample(trips(spark, folder), "pickup_datetime", "dev", "1999-01-01", "1999-02-01"),
                      "service_type")


@query("F11", over("""
SELECT count(*) AS n FROM trips WHERE pickup_datetime > (SELECT max(pickup_datetime) FROM trips
WHERE service_type = 'Green' AND pickup_datetime < TIMESTAMP '2000-01-01')"""))
def newer_than_stored(spark, folder):
    all_trips = trips(spark, folder)
    stored_max = (all_trips.filter("service_type = 'Green' AND pickup_datetime < timestamp'2000-01-01'")
                  .agg(F.max("pickup_datetime")).scalar())
    return all_trips.filter(F.col("pickup_datetime") > stored_max).agg(F.count("*").alias("n"))


@query("P17 O03 S18", over("""
SELECT service_type, max(n) AS busiest FROM (
  SELECT service_type, date_trunc('month', pickup_datetime) AS m, count(*) AS n FROM trips GROUP BY 1, 2)
GROUP BY 1"""))
def nested_cte(spark, folder):
    """SQL text over a registered view: nested CTEs, group and order by position."""
    register(trips(spark, folder), "meterline_trips")
    return spark.sql("""
        WITH months AS (
          WITH dated AS (SELECT service_type, date_trunc('month', pickup_datetime) AS m FROM meterline_trips)
          SELECT service_type, m, count(*) AS n FROM dated GROUP BY 1, 2)
        SELECT service_type, max(n) AS busiest FROM months GROUP BY 1 ORDER BY 1""")
