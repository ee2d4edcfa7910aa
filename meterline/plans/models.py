"""Staging, intermediate and mart tables, each from the frames below it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import scalars as X
from meterline.lookups import VENDOR_NAMES
from meterline.operators import columns as P
from meterline.operators import filters
from meterline.operators.joins import lookup_join
from meterline.operators.sets import concat_frames, union_trips
from meterline.operators.windows import dedup
from meterline.plans import reports
from meterline.sinks.files import write_parquet
from meterline.sinks.materialize import high_water, materialize
from meterline.sources.files import read_parquet

NUMERIC = "decimal(18,3)"  # fixed-point width of the embedded profile; pass a wider one if needed

# Raw name, trip name and type; ``{p}`` is the service's time prefix.
_IDS = [("vendorid", "vendor_id"), ("ratecodeid", "rate_code_id"),
        ("pulocationid", "pickup_location_id"), ("dolocationid", "dropoff_location_id")]
_AMOUNTS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
            "improvement_surcharge", "total_amount"]
_DEV_MONTH = {"Green": ("2019-01-01", "2019-02-01"), "Yellow": ("2024-01-01", "2024-02-01")}


def _staged(raw: DataFrame, service: str, numeric: str, target: str, window) -> DataFrame:
    prefix = {"Green": "lpep", "Yellow": "tpep"}[service]
    columns = [F.col(old).cast("int").alias(new) for old, new in _IDS]
    columns += [F.col(f"{prefix}_{end}_datetime").cast("timestamp").alias(f"{end}_datetime")
                for end in ("pickup", "dropoff")]
    columns += [F.col("store_and_fwd_flag"), F.col("passenger_count").cast("int").alias("passenger_count"),
                F.col("trip_distance").cast(numeric).alias("trip_distance")]
    if service == "Green":
        fee = F.col("ehail_fee").cast(numeric) if "ehail_fee" in raw.columns else P.filler(None, numeric)
        columns += [F.col("trip_type").cast("int").alias("trip_type"), fee.alias("ehail_fee")]
    columns += [F.col(c).cast(numeric).alias(c) for c in _AMOUNTS]
    columns.append(F.col("payment_type").cast("int").alias("payment_type"))
    known = filters.not_null(raw, "vendorid").select(*columns)
    return filters.dev_sample(known, "pickup_datetime", target, *(window or _DEV_MONTH[service]))


def stg_green_tripdata(tables: dict[str, DataFrame], numeric: str = NUMERIC, target: str = "prod",
                       window: tuple | None = None) -> DataFrame:
    """Typed, renamed green trips with a vendor. The fee column is null where the raw table lacks it."""
    return _staged(tables["green_tripdata"], "Green", numeric, target, window)


def stg_yellow_tripdata(tables: dict[str, DataFrame], numeric: str = NUMERIC, target: str = "prod",
                        window: tuple | None = None) -> DataFrame:
    return _staged(tables["yellow_tripdata"], "Yellow", numeric, target, window)


def stg_fhv_tripdata(tables: dict[str, DataFrame]) -> DataFrame:
    raw = filters.not_null(tables["fhv_tripdata"], "dispatching_base_num")
    return raw.select(
        F.trim(F.col("dispatching_base_num").cast("string")).alias("dispatching_base_num"),
        F.col("pulocationid").cast("int").alias("pickup_location_id"),
        F.col("dolocationid").cast("int").alias("dropoff_location_id"),
        F.col("pickup_datetime").cast("timestamp").alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("timestamp").alias("dropoff_datetime"))


def int_trips_unioned(tables: dict[str, DataFrame], numeric: str = NUMERIC, **staging) -> DataFrame:
    """Both services under one set of columns; what a service lacks is a typed constant."""
    green = P.tag(stg_green_tripdata(tables, numeric, **staging), "service_type", "Green")
    yellow = (stg_yellow_tripdata(tables, numeric, **staging)
              .withColumns({"trip_type": P.filler(1, "int"), "ehail_fee": P.filler(0, numeric),
                            "service_type": F.lit("Yellow")}))
    return union_trips(green, yellow)


TRIP_KEY = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]


def int_trips(tables: dict[str, DataFrame], **staging) -> DataFrame:
    """One row per trip key, with its surrogate key and payment label.

    The kept row is the one with the earliest drop-off; all other columns break ties.
    """
    unioned = int_trips_unioned(tables, **staging).withColumn(
        "payment_type", F.coalesce("payment_type", F.lit(0)))
    others = [c for c in unioned.columns if c not in [*TRIP_KEY, "dropoff_datetime"]]
    single = dedup(unioned, TRIP_KEY, ["dropoff_datetime", *others])
    # Deduplicated first: the payment code is unique in its lookup, so the join adds no rows.
    labelled = lookup_join(single, tables["payment_type_lookup"], "payment_type", "payment_type",
                           {"description": "_label"})
    return (labelled
            .withColumn("payment_type_description", F.coalesce("_label", F.lit("Unknown")))
            .withColumn("trip_id", P.surrogate_key(*TRIP_KEY))
            .drop("_label"))


def dim_zones(tables: dict[str, DataFrame]) -> DataFrame:
    zones = P.normalize_headers(tables["taxi_zone_lookup"])
    return zones.select(F.col("locationid").alias("location_id"), "borough", "zone", "service_zone")


def vendor_name(column: str = "vendor_id"):
    return P.code_label(F.col(column), VENDOR_NAMES)


FACT_COLUMNS = [
    "trip_id", "vendor_id", "service_type", "rate_code_id",
    "pickup_location_id", "pickup_borough", "pickup_zone",
    "dropoff_location_id", "dropoff_borough", "dropoff_zone",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
    "passenger_count", "trip_distance", "trip_type", "trip_duration_minutes",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "payment_type_description",
]


def fct_trips(tables: dict[str, DataFrame], newer_than=None, **staging) -> DataFrame:
    """Trips with both zone names. ``newer_than`` keeps later pickups only (incremental load).

    The bound is applied before the zone joins; ``load_fct_trips`` takes it from the stored table.
    """
    trips = int_trips(tables, **staging)
    if newer_than is not None:
        trips = trips.filter(F.col("pickup_datetime") > F.lit(newer_than))
    zones = dim_zones(tables)
    for end in ("pickup", "dropoff"):
        trips = lookup_join(trips, zones, f"{end}_location_id", "location_id",
                            {"borough": f"{end}_borough", "zone": f"{end}_zone"})
    return trips.withColumn(
        "trip_duration_minutes", X.minutes_between("pickup_datetime", "dropoff_datetime")).select(*FACT_COLUMNS)


def load_fct_trips(tables: dict[str, DataFrame], target: str, lookback: str | None = None, full_refresh: bool = False,
                   **staging) -> bool:
    """Bring the stored fact up to date: trips picked up after the newest stored one, merged on ``trip_id``.

    The first load and ``full_refresh`` take everything. Trips that arrive later than a newer one stay out, unless
    ``lookback`` moves the bound back; columns that changed stop the load. The key is made from the pickup time
    among others, so a trip never moves to another month and a load rewrites the months of its own trips only.
    """
    spark = tables["taxi_zone_lookup"].sparkSession
    bound = None if full_refresh else high_water(spark, target, "pickup_datetime", lookback)
    fact = fct_trips(tables, newer_than=bound, **staging)
    return materialize(fact, target, "merge", keys=["trip_id"], full_refresh=full_refresh, day_of="pickup_datetime",
                       period="month", day_in_key=True)


def dim_vendors(tables: dict[str, DataFrame], **staging) -> DataFrame:
    """Distinct vendors of the fact. Takes ``tables['fct_trips']`` when it is already built."""
    fact = tables["fct_trips"] if "fct_trips" in tables else fct_trips(tables, **staging)
    return fact.select("vendor_id").distinct().withColumn("vendor_name", vendor_name())


def fct_monthly_zone_revenue(tables: dict[str, DataFrame], **staging) -> DataFrame:
    fact = tables["fct_trips"] if "fct_trips" in tables else fct_trips(tables, **staging)
    return reports.monthly_zone_name_revenue(fact)


STAGED_KEY = ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "fare_amount"]


def staging_trips(tables: dict[str, DataFrame], start, end) -> DataFrame:
    """Trips of an interval with payment names, one per key.

    The key holds no service, so equal yellow and green trips collapse to one.
    """
    inside = tables["trips"].filter(filters.in_range("pickup_datetime", start, end))
    single = dedup(inside, STAGED_KEY, ["taxi_type", "payment_type"])
    named = lookup_join(single, tables["payment_lookup"], "payment_type", "payment_type_id",
                        {"payment_type_name": "payment_type_name"})
    return named.select(*STAGED_KEY, "taxi_type", "payment_type_name")


def trips_report(tables: dict[str, DataFrame], start, end) -> DataFrame:
    """Daily report of an interval. Both bounds must be midnights.

    Its rows replace whole days, so a bound inside a day would overwrite a full
    day with a part of it.
    """
    for bound in (start, end):
        text = str(bound)
        if len(text) > 10 and text[10:].strip(" T0:.") != "":
            raise ValueError(f"report bounds must be midnights, got {bound!r}")
    return reports.trips_report(tables["staging_trips"], start, end)


def monthly_revenue_job(spark, green_path: str, yellow_path: str, output: str) -> None:
    """Monthly revenue from two Parquet inputs to one file, as a job would run it."""
    frames = []
    for path, prefix, name in ((green_path, "lpep", "green"), (yellow_path, "tpep", "yellow")):
        raw = P.rename(read_parquet(spark, path), {f"{prefix}_pickup_datetime": "pickup_datetime",
                                                   f"{prefix}_dropoff_datetime": "dropoff_datetime"})
        frames.append((raw, name))
    shared = P.common_columns(frames[0][0], frames[1][0])
    trips = union_trips(*[P.tag(raw.select(*shared), "service_type", name) for raw, name in frames])
    # Grouped rows only: months x zones x services, small enough for one file.
    write_parquet(reports.monthly_zone_revenue(trips, zone="PULocationID"), output, mode="overwrite", files=1)


def example_chain(first: DataFrame, second: DataFrame, column: str = "id", value=1) -> tuple[DataFrame, DataFrame]:
    """Two chained models: stacked rows with the column set, then those equal to a value."""
    base = filters.not_null(concat_frames(first, second), column)
    return base, base.filter(F.col(column) == value)
