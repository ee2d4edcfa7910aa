"""Named trip reports, each from plain trip and zone frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions import scalars as X
from meterline.operators import aggregates as A
from meterline.operators import filters
from meterline.operators.joins import lookup_join, outer_on_keys
from meterline.operators.windows import percentile_in_group

MONTHLY_SUMS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                "improvement_surcharge", "total_amount", "congestion_surcharge"]


def _monthly_sums(columns: list[str]) -> list[Column]:
    short = {"fare_amount": "fare"}
    return [F.sum(c).alias(f"revenue_monthly_{short.get(c, c)}") for c in columns]


def _monthly_averages() -> list[Column]:
    return [F.avg(c).alias(f"avg_monthly_{c}") for c in ("passenger_count", "trip_distance")]


def monthly_zone_revenue(trips: DataFrame, zone: str = "pickup_location_id") -> DataFrame:
    return (trips.groupBy(F.col(zone).alias("revenue_zone"),
                          X.trunc_to("pickup_datetime", "month").alias("revenue_month"),
                          "service_type")
            .agg(*_monthly_sums(MONTHLY_SUMS), *_monthly_averages()))


def monthly_zone_name_revenue(trips: DataFrame) -> DataFrame:
    """The monthly mart: by zone name, with a default for trips outside all zones."""
    measures = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
                "improvement_surcharge", "total_amount"]
    return (trips.groupBy(F.coalesce("pickup_zone", F.lit("Unknown Zone")).alias("pickup_zone"),
                          X.trunc_to("pickup_datetime", "month").alias("revenue_month"),
                          "service_type")
            .agg(*_monthly_sums(measures), F.count("*").alias("total_monthly_trips"),
                 *_monthly_averages()))


def hourly_zone_revenue(trips: DataFrame, start, ts: str = "pickup_datetime",
                        zone: str = "pickup_location_id", amount: str = "amount",
                        number: str = "number_records") -> DataFrame:
    return (trips.filter(filters.since(ts, start))
            .groupBy(X.trunc_to(ts, "hour").alias("hour"), F.col(zone).alias("zone"))
            .agg(F.sum("total_amount").alias(amount), F.count("*").alias(number)))


def hourly_green_yellow(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Hourly revenue of both services side by side; an hour may have only one."""
    named = lambda df, service: df.withColumnsRenamed({
        "amount": f"{service}_amount", "number_records": f"{service}_number_records"})
    return outer_on_keys(named(green, "green"), named(yellow, "yellow"), ["hour", "zone"])


def revenue_with_zones(hourly: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone names in place of zone ids; hours of unknown zones drop out."""
    return lookup_join(hourly.withColumnRenamed("zone", "_zone_id"), zones, "_zone_id", "LocationID",
                       {"Borough": "Borough", "Zone": "Zone", "service_zone": "service_zone"},
                       how="inner").drop("_zone_id")


def zone_revenue_report(green: DataFrame, yellow: DataFrame, zones: DataFrame, start) -> DataFrame:
    """Whole report in one plan; nothing is written between the steps."""
    hourly = [hourly_zone_revenue(df, start, ts=f"{p}_pickup_datetime", zone="PULocationID")
              for df, p in ((green, "lpep"), (yellow, "tpep"))]
    return revenue_with_zones(hourly_green_yellow(*hourly), zones)


def short_trip_count(trips: DataFrame, start, end, max_distance: float) -> DataFrame:
    return (trips.filter(filters.in_range("pickup_datetime", start, end))
            .filter(F.col("trip_distance") <= max_distance).agg(F.count("*").alias("trip_count")))


def longest_trip_per_day(trips: DataFrame, below: float, k: int) -> DataFrame:
    days = (trips.filter(F.col("trip_distance") < below)
            .groupBy(X.day_of("pickup_datetime").alias("pickup_day"))
            .agg(F.max("trip_distance").alias("max_trip_distance")))
    return A.top_k(days, [F.col("max_trip_distance").desc(), F.col("pickup_day")], k)


def zone_revenue_on_day(trips: DataFrame, zones: DataFrame, day, k: int) -> DataFrame:
    """Top zones of one day. Trips are summed per zone id before zones are joined."""
    by_id = (trips.filter(filters.on_day("pickup_datetime", day))
             .groupBy("pickup_location_id").agg(F.sum("total_amount").alias("_sum")))
    by_name = (lookup_join(by_id, zones, "pickup_location_id", "LocationID", {"Zone": "pickup_zone"}, "inner")
               .groupBy("pickup_zone").agg(F.sum("_sum").alias("total_amount_sum")))
    return A.top_k(by_name, [F.col("total_amount_sum").desc(), F.col("pickup_zone")], k)


def max_tip_by_dropoff(trips: DataFrame, zones: DataFrame, pickup_zone: str, first, last, k: int) -> DataFrame:
    """Largest tip per drop-off zone for trips from one zone; days inclusive."""
    by_ids = (trips.filter(filters.between_days("pickup_datetime", first, last))
              .groupBy("pickup_location_id", "dropoff_location_id").agg(F.max("tip_amount").alias("_tip")))
    named = lookup_join(by_ids, zones, "pickup_location_id", "LocationID", {"Zone": "_from"}, "inner")
    named = lookup_join(named.filter(F.col("_from") == pickup_zone), zones,
                        "dropoff_location_id", "LocationID", {"Zone": "dropoff_zone"}, "inner")
    tips = named.groupBy("dropoff_zone").agg(F.max("_tip").alias("total_tip_amount"))
    return A.top_k(tips, [F.col("total_tip_amount").desc(), F.col("dropoff_zone")], k)


def _by_zone_name(counts: DataFrame, zones: DataFrame) -> DataFrame:
    return (lookup_join(counts, zones, "pickup_location_id", "LocationID", {"Zone": "Zone"})
            .groupBy("Zone").agg(F.sum("_n").alias("n")))


def pickup_counts(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips per pickup zone name; trips outside all zones count under null."""
    return _by_zone_name(A.count_by(trips, "pickup_location_id", name="_n"), zones)


def least_frequent_zone(trips: DataFrame, zones: DataFrame, k: int) -> DataFrame:
    return A.top_k(pickup_counts(trips, zones), [F.col("n").asc(), F.col("Zone").asc_nulls_last()], k)


def top_zone_pairs(trips: DataFrame, zones: DataFrame, k: int) -> DataFrame:
    """Most frequent pickup / drop-off pair; one unknown side makes the pair null."""
    ids = A.count_by(trips, "pickup_location_id", "dropoff_location_id", name="_n")
    named = lookup_join(ids, zones, "pickup_location_id", "LocationID", {"Zone": "_from"})
    named = lookup_join(named, zones, "dropoff_location_id", "LocationID", {"Zone": "_to"})
    pairs = (named.groupBy(F.concat("_from", F.lit(" / "), "_to").alias("pu_do_pair"))
             .agg(F.sum("_n").alias("n")))
    return A.top_k(pairs, [F.col("n").desc(), F.col("pu_do_pair").asc_nulls_last()], k)


def max_duration_per_day(trips: DataFrame, k: int, per: float | None = None) -> DataFrame:
    """Longest trip of each day in seconds, or in units of ``per`` seconds."""
    seconds = X.to_seconds("dropoff_datetime") - X.to_seconds("pickup_datetime")
    value = seconds if per is None else seconds / F.lit(float(per))
    days = (trips.groupBy(X.day_of("pickup_datetime").alias("pickup_date"))
            .agg(F.max(value).alias("duration")))
    return A.top_k(days, [F.col("duration").desc(), F.col("pickup_date")], k)


def max_duration_hours(trips: DataFrame) -> DataFrame:
    seconds = X.to_seconds("dropoff_datetime") - X.to_seconds("pickup_datetime")
    return trips.agg(F.max(seconds / F.lit(3600.0)).alias("max_hours"))


def duration_p90(trips: DataFrame, p: float = 0.9, **options) -> DataFrame:
    """Each trip's seconds beside the percentile of its pickup zone."""
    timed = trips.select("pickup_location_id",
                         X.seconds_between("pickup_datetime", "dropoff_datetime").alias("trip_duration"))
    return percentile_in_group(timed, ["pickup_location_id"], "trip_duration", p, "trip_duration_p90", **options)


def trips_report(trips: DataFrame, start, end) -> DataFrame:
    return (trips.filter(filters.in_range("pickup_datetime", start, end))
            .groupBy(X.day_of("pickup_datetime").alias("trip_date"), "taxi_type",
                     F.col("payment_type_name").alias("payment_type"))
            .agg(F.count("*").alias("trip_count"), F.sum("fare_amount").alias("total_fare"),
                 F.avg("fare_amount").alias("avg_fare")))
