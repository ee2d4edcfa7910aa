"""Declared schemas of the input files, as DDL text. Every field is nullable.

Fixed values: field names and types of the published trip-record files.
"""

from __future__ import annotations

GREEN = """
    VendorID int, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp,
    store_and_fwd_flag string, RatecodeID int, PULocationID int, DOLocationID int,
    passenger_count int, trip_distance double, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double, ehail_fee double,
    improvement_surcharge double, total_amount double, payment_type int,
    trip_type int, congestion_surcharge double
"""

YELLOW = """
    VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,
    passenger_count int, trip_distance double, RatecodeID int, store_and_fwd_flag string,
    PULocationID int, DOLocationID int, payment_type int, fare_amount double,
    extra double, mta_tax double, tip_amount double, tolls_amount double,
    improvement_surcharge double, total_amount double, congestion_surcharge double
"""

HIGH_VOLUME = """
    hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp,
    dropoff_datetime timestamp, PULocationID int, DOLocationID int, SR_Flag string
"""

FOR_HIRE = """
    dispatching_base_num string, pickup_datetime timestamp, dropoff_datetime timestamp,
    pulocationid int, dolocationid int
"""

# Raw files as they are ingested: header names in lower case, coerced types.
INGEST_YELLOW = """
    vendorid bigint, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,
    passenger_count bigint, trip_distance double, ratecodeid bigint, store_and_fwd_flag string,
    pulocationid bigint, dolocationid bigint, payment_type bigint, fare_amount double,
    extra double, mta_tax double, tip_amount double, tolls_amount double,
    improvement_surcharge double, total_amount double, ehail_fee double,
    congestion_surcharge double, airport_fee double
"""

INGEST_GREEN = """
    vendorid bigint, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp,
    store_and_fwd_flag string, ratecodeid bigint, pulocationid bigint, dolocationid bigint,
    passenger_count bigint, trip_distance double, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double, ehail_fee double,
    improvement_surcharge double, total_amount double, payment_type bigint,
    trip_type bigint, congestion_surcharge double, airport_fee double
"""

INGEST_FOR_HIRE = """
    dispatching_base_num string, pickup_datetime timestamp, dropoff_datetime timestamp,
    pulocationid bigint, dolocationid bigint
"""

# Columns that only some years of the files have.
INGEST_OPTIONAL = {"trip_type", "ehail_fee", "congestion_surcharge", "airport_fee"}

# Raw tables as the warehouse stores them: lower-case names, wide integers.
_RAW_SHARED = """
    vendorid bigint, ratecodeid bigint, pulocationid bigint, dolocationid bigint,
    {p}_pickup_datetime timestamp, {p}_dropoff_datetime timestamp,
    store_and_fwd_flag string, passenger_count bigint, trip_distance double,
    fare_amount double, extra double, mta_tax double, tip_amount double,
    tolls_amount double, improvement_surcharge double, total_amount double,
    payment_type bigint
"""
RAW_YELLOW = _RAW_SHARED.format(p="tpep")
RAW_GREEN = _RAW_SHARED.format(p="lpep") + ", trip_type bigint"

ZONES = "LocationID int, Borough string, Zone string, service_zone string"
PAYMENT_DESCRIPTIONS = "payment_type int, description string"
PAYMENT_NAMES = "payment_type_id int, payment_type_name string"

NORMALISED_TRIPS = """
    pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id int,
    dropoff_location_id int, fare_amount double, taxi_type string, payment_type int
"""

# Columns of the service files that hold a shared column, in order of preference.
TRIP_SOURCES = {
    "pickup_datetime": ["tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime"],
    "dropoff_datetime": ["tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff_datetime"],
    "pickup_location_id": ["PULocationID", "pickup_location_id"],
    "dropoff_location_id": ["DOLocationID", "dropoff_location_id"],
}

RIDE_EVENT = """
    PULocationID int, DOLocationID int, trip_distance double, total_amount double,
    tpep_pickup_datetime bigint
"""

GREEN_EVENT = """
    lpep_pickup_datetime string, lpep_dropoff_datetime string, PULocationID int,
    DOLocationID int, passenger_count double, trip_distance double,
    tip_amount double, total_amount double
"""
