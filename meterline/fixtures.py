"""The shared test tables seen as trips, zones and raw per-service tables.

The same mapping exists once as DataFrame code and once as SQL text, so that
every query can be compared with an independent engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import load_table

MONEY = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
         "improvement_surcharge", "total_amount", "congestion_surcharge"]

# Columns that tell any two trips apart; they end every ordering.
TIE_BREAK = ["source_order", "source_line", "source_part", "source_supplier"]


def _cents(value):
    """Half-up to cents by floor, which every engine computes alike."""
    return F.floor(value * 100 + F.lit(0.5)).cast("double") / F.lit(100.0)


def _plus_seconds(ts, seconds):
    return F.timestamp_micros(F.unix_micros(ts) + seconds * 1_000_000)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    line = load_table(spark, folder, "lineitem")
    orders = load_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = load_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    supplier = load_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    # Customers meet the orders first: there are fewer of these, and lines move once.
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    joined = (line.join(placed, line.l_orderkey == placed.o_orderkey)
              .join(supplier, line.l_suppkey == supplier.s_suppkey))
    pickup = _plus_seconds(F.col("o_orderdate"), F.col("o_orderkey") % 86400)
    return (
        joined
        .select(
            (F.col("l_suppkey") % 5).cast("int").alias("vendor_id"),
            F.col("l_linenumber").alias("rate_code_id"),
            F.col("c_nationkey").alias("pickup_location_id"),
            F.col("s_nationkey").alias("dropoff_location_id"),
            pickup.alias("pickup_datetime"),
            (F.col("l_quantity") * 60 + F.col("l_linenumber") * 7).cast("bigint").alias("_seconds"),
            F.col("l_linenumber").alias("passenger_count"),
            F.col("l_quantity").alias("trip_distance"),
            F.col("l_extendedprice").alias("fare_amount"),
            (F.col("l_linenumber") % 3 * F.lit(0.5)).alias("extra"),
            _cents(F.col("l_extendedprice") * F.col("l_tax")).alias("mta_tax"),
            _cents(F.col("l_extendedprice") * F.col("l_discount")).alias("tip_amount"),
            F.when(F.col("l_partkey") % 10 == 0, 6.5).otherwise(0.0).alias("tolls_amount"),
            F.lit(0.25).alias("improvement_surcharge"),
            F.when(F.col("l_partkey") % 2 == 0, 2.5).otherwise(0.0).alias("congestion_surcharge"),
            (F.col("l_linenumber") % 2 + 1).alias("trip_type"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"),
            F.when(F.col("l_linestatus") == "F", "Green").otherwise("Yellow").alias("service_type"),
            F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("store_and_fwd_flag"),
            F.concat("l_returnflag", "l_linestatus").alias("dispatching_base_num"),
            F.col("l_orderkey").alias("source_order"),
            F.col("l_linenumber").alias("source_line"),
            F.col("l_partkey").alias("source_part"),
            F.col("l_suppkey").alias("source_supplier"),
        )
        .withColumn("dropoff_datetime", _plus_seconds(F.col("pickup_datetime"), F.col("_seconds")))
        .withColumn("total_amount", F.col("fare_amount") + F.col("tip_amount") + F.col("mta_tax"))
        .drop("_seconds")
    )


TRIPS_SQL = """
trips AS (
  SELECT vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime,
         pickup_datetime + to_seconds(CAST(l_quantity * 60 + l_linenumber * 7 AS INTEGER)) AS dropoff_datetime,
         l_linenumber AS passenger_count, l_quantity AS trip_distance,
         l_extendedprice AS fare_amount, (l_linenumber % 3) * CAST(0.5 AS DOUBLE) AS extra,
         mta_tax, tip_amount,
         CAST(CASE WHEN l_partkey % 10 = 0 THEN 6.5 ELSE 0 END AS DOUBLE) AS tolls_amount,
         CAST(0.25 AS DOUBLE) AS improvement_surcharge,
         CAST(CASE WHEN l_partkey % 2 = 0 THEN 2.5 ELSE 0 END AS DOUBLE) AS congestion_surcharge,
         l_extendedprice + tip_amount + mta_tax AS total_amount,
         l_linenumber % 2 + 1 AS trip_type,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
         CASE WHEN l_linestatus = 'F' THEN 'Green' ELSE 'Yellow' END AS service_type,
         CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         l_returnflag || l_linestatus AS dispatching_base_num,
         l_orderkey AS source_order, l_linenumber AS source_line,
         l_partkey AS source_part, l_suppkey AS source_supplier
  FROM (
    SELECT l.*, o.*, CAST(l_suppkey % 5 AS INTEGER) AS vendor_id, l_linenumber AS rate_code_id,
           c_nationkey AS pickup_location_id, s_nationkey AS dropoff_location_id,
           o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS INTEGER)) AS pickup_datetime,
           floor(l_extendedprice * l_tax * 100 + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE) AS mta_tax,
           floor(l_extendedprice * l_discount * 100 + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE) AS tip_amount
    FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
         JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)
)"""


def zones(spark: SparkSession, folder: str, known: int | None = None) -> DataFrame:
    """Nations as zones. ``known`` keeps the first ids only, so some trips find no zone."""
    nation = load_table(spark, folder, "nation")
    region = load_table(spark, folder, "region")
    out = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("n_nationkey") % 2 == 0, "Yellow Zone").otherwise("Boro Zone").alias("service_zone"))
    return out if known is None else out.filter(F.col("LocationID") < known)


def zones_sql(known: int | None = None, name: str = "zones") -> str:
    where = f"WHERE n_nationkey < {known}" if known is not None else ""
    return f"""
{name} AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
         CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey {where}
)"""


# Raw file columns and the trip column each is filled from.
_RAW = {
    "vendorid": "vendor_id", "ratecodeid": "rate_code_id",
    "pulocationid": "pickup_location_id", "dolocationid": "dropoff_location_id",
    "{p}_pickup_datetime": "pickup_datetime", "{p}_dropoff_datetime": "dropoff_datetime",
    "store_and_fwd_flag": "store_and_fwd_flag", "passenger_count": "passenger_count",
    "trip_distance": "trip_distance", "fare_amount": "fare_amount", "extra": "extra",
    "mta_tax": "mta_tax", "tip_amount": "tip_amount", "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge", "total_amount": "total_amount",
    "payment_type": "payment_type", "congestion_surcharge": "congestion_surcharge",
}

_FILE_NAMES = {"vendorid": "VendorID", "ratecodeid": "RatecodeID",
               "pulocationid": "PULocationID", "dolocationid": "DOLocationID"}


def raw_service(spark: SparkSession, folder: str, service: str, file_names: bool = False,
                rows: DataFrame | None = None) -> DataFrame:
    """One service's trips under the raw column names, lower case or as in the files. ``rows`` are trips at hand."""
    prefix = {"Green": "lpep", "Yellow": "tpep"}[service]
    fields = dict(_RAW)
    if service == "Green":
        fields["trip_type"] = "trip_type"
    df = (trips(spark, folder) if rows is None else rows).filter(F.col("service_type") == service)
    return df.select(*[
        F.col(source).alias((_FILE_NAMES.get(raw, raw) if file_names else raw).format(p=prefix))
        for raw, source in fields.items()
    ])


def for_hire(spark: SparkSession, folder: str) -> DataFrame:
    """Trips as the for-hire file shows them; every seventh base code is missing."""
    return trips(spark, folder).select(
        F.when(F.col("source_part") % 7 != 0, F.concat(F.lit(" "), "dispatching_base_num", F.lit(" ")))
        .alias("dispatching_base_num"),
        "pickup_datetime", "dropoff_datetime",
        F.col("pickup_location_id").alias("pulocationid"),
        F.col("dropoff_location_id").alias("dolocationid"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "events")
