"""Code lists of the trip domain.

Fixed values: published codes and labels, equal to the source data's own lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline import schemas

VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
    4: "Unknown/Other",
}

PAYMENT_DESCRIPTIONS = {
    0: "Unknown",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

PAYMENT_NAMES = {
    0: "flex_fare",
    1: "credit_card",
    2: "cash",
    3: "no_charge",
    4: "dispute",
    5: "unknown",
    6: "voided_trip",
}

FOR_HIRE_ALIASES = {
    "drop_off_datetime": "dropoff_datetime",
    "pickup_date": "pickup_datetime",
    "dropoff_date": "dropoff_datetime",
}


def payment_descriptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PAYMENT_DESCRIPTIONS.items()), schemas.PAYMENT_DESCRIPTIONS)


def payment_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PAYMENT_NAMES.items()), schemas.PAYMENT_NAMES)
