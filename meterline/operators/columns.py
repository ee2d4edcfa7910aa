"""Column work: naming, projecting, casting, labelling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline import schemas
from meterline.functions.scalars import finite_or_null


_WHOLE = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"  # the text that casts to bigint, range aside


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def normalize_headers(df: DataFrame) -> DataFrame:
    """Strip, lower-case and underscore every header."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def apply_aliases(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Fill a missing column from the variant name it has in some files."""
    missing = {new: F.col(old) for old, new in aliases.items()
               if old in df.columns and new not in df.columns}
    return df.withColumns(missing) if missing else df


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both frames have, in the left frame's order."""
    shared = set(right.columns)
    return [c for c in left.columns if c in shared]


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def tag(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def filler(value, sql_type: str) -> Column:
    """A constant of a given type, null included, for columns a source lacks."""
    return F.lit(value).cast(sql_type)


def cast_strict(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit stops the job."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def coerce(df: DataFrame, ints: list[str] = (), floats: list[str] = (),
           timestamps: list[str] = (), strings: list[str] = ()) -> DataFrame:
    """Cast the listed columns that exist; a value that does not fit becomes null.

    Whole numbers keep all digits; ``1.0`` written as text is 1. NaN and infinities are missing numbers.
    """
    plan: dict[str, Column] = {}
    for c in ints:
        # A cast that fails costs many times one that succeeds, so text that is no whole number isn't tried as one.
        whole = F.when(F.col(c).rlike(_WHOLE), F.col(c)) if dict(df.dtypes).get(c) == "string" else F.col(c)
        plan[c] = F.coalesce(whole.try_cast("bigint"), F.col(c).try_cast("double").try_cast("bigint"))
    for c in floats:
        plan[c] = finite_or_null(F.col(c).try_cast("double"))
    for c in timestamps:
        plan[c] = F.col(c).try_cast("timestamp")
    for c in strings:
        plan[c] = F.col(c).cast("string")
    present = {c: e for c, e in plan.items() if c in df.columns}
    return df.withColumns(present) if present else df


def code_label(code: Column, labels: dict) -> Column:
    """Label of a code; a code without one gives null."""
    cases = list(labels.items())
    first = F.when(code == F.lit(cases[0][0]), F.lit(cases[0][1]))
    return reduce(lambda chain, kv: chain.when(code == F.lit(kv[0]), F.lit(kv[1])), cases[1:], first)


def surrogate_key(*columns: str) -> Column:
    """Hash of several columns in order; null differs from any text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("_null_")) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def normalize_trips(df: DataFrame, taxi_type: str) -> DataFrame:
    """Bring one service's file columns to the shared trip columns, those the file has.

    Each shared column takes the first of its accepted source columns that is there.
    """
    named = tag(df, "taxi_type", taxi_type)
    shared = [field.split()[0] for field in schemas.NORMALISED_TRIPS.split(",")]
    found = {c: next((s for s in schemas.TRIP_SOURCES.get(c, [c]) if s in named.columns), None) for c in shared}
    return named.select(*[F.col(source).alias(c) for c, source in found.items() if source])


def child_table(df: DataFrame, key: str, field: str) -> DataFrame:
    """Unfold a list column to rows of (key, index, value)."""
    return df.select(F.col(key), F.posexplode(field).alias("index", "value"))
