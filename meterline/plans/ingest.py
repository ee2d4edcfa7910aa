"""Raw CSV to typed Parquet, one data set at a time."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from meterline import schemas
from meterline.lookups import FOR_HIRE_ALIASES
from meterline.operators import columns as P
from meterline.operators.quality import required_columns, run_checks
from meterline.sources.files import path_exists, read_csv

DATA_SETS = {"yellow": schemas.INGEST_YELLOW, "green": schemas.INGEST_GREEN, "fhv": schemas.INGEST_FOR_HIRE}


def ingest_raw(spark: SparkSession, source: str, target: str, data_set: str) -> bool:
    """Read CSV as text, settle headers, coerce and store; tells whether it ran.

    Yellow and green files keep every column, for-hire files the declared ones.
    Finished output is left alone. Values that do not fit become null; a missing
    required column stops the load. Gzip files cannot be split, so the rows are
    rebalanced before the write.
    """
    if path_exists(spark, f"{target.rstrip('/')}/_SUCCESS"):
        return False
    declared = T.StructType.fromDDL(DATA_SETS[data_set])
    of_type = lambda kind: [f.name for f in declared.fields if isinstance(f.dataType, kind)]
    raw = P.normalize_headers(read_csv(spark, source))
    if data_set == "fhv":
        raw = P.apply_aliases(raw, FOR_HIRE_ALIASES)
    run_checks(raw, [required_columns([c for c in declared.names if c not in schemas.INGEST_OPTIONAL])]).raise_on_failure()
    kept = P.select_existing(raw, declared.names) if data_set == "fhv" else raw
    typed = P.coerce(kept, of_type(T.LongType), of_type(T.DoubleType), of_type(T.TimestampType), of_type(T.StringType))
    typed.hint("rebalance").write.mode("overwrite").parquet(target)
    return True
