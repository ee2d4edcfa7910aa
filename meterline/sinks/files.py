"""File, table and record sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions import scalars as X
from meterline.operators import filters
from meterline.operators.quality import schema_differences
from meterline.sources.files import path_exists, read_csv


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None) -> None:
    """Parquet write. ``files`` fixes the file count.

    The rows are shuffled to that many writers, so that what comes before keeps
    its own parallelism even when one file is asked for.
    """
    if files is not None:
        df = df.repartition(files)
    df.write.mode(mode).parquet(path)


def write_months(df: DataFrame, path: str, ts: str, by: tuple[str, ...] = (), mode: str = "errorifexists") -> None:
    """Directories per (further columns,) year and month of a timestamp.

    The rebalance gathers each directory's rows into few files and lets AQE split
    a directory that is too large for one task.
    """
    dated = df.withColumns({"year": F.year(ts), "month": F.month(ts)})
    keys = [*by, "year", "month"]
    dated.hint("rebalance", *[F.col(k) for k in keys]).write.mode(mode).partitionBy(*keys).parquet(path)


def write_partitioned(df: DataFrame, path: str, date_of: str, cluster_by: str, mode: str = "errorifexists",
                      day_column: str = "day") -> None:
    """Partition by the date of a timestamp and sort inside by a column.

    Sorting gives each row group a narrow value range, so filters on the
    clustering column skip row groups. A day too large for one task is split.
    """
    dated = df.withColumn(day_column, F.to_date(date_of))
    (dated.hint("rebalance", F.col(day_column)).sortWithinPartitions(day_column, cluster_by)
     .write.mode(mode).partitionBy(day_column).parquet(path))


def partition_range(ts: str, first, last, day_column: str = "day") -> Column:
    """Inclusive day range on a timestamp plus the same range on its partition column.

    The second half lets the scan skip directories; it removes no further rows.
    """
    return (filters.between_days(ts, first, last)
            & F.col(day_column).between(F.lit(str(first)[:10]).cast("date"), F.lit(str(last)[:10]).cast("date")))


def load(df: DataFrame, path: str, schema: str) -> None:
    """Truncate and load under a declared schema; any difference stops the load."""
    wanted = df.sparkSession.createDataFrame([], schema).schema
    problems = schema_differences(df.schema, wanted)
    if problems:
        raise ValueError("load refused: " + "; ".join(problems))
    df.select(*wanted.names).write.mode("overwrite").parquet(path)


def jdbc_options(url: str, table: str, batch: int = 100_000, connections: int = 8, **options: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch), "numPartitions": str(connections), **options}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", batch: int = 100_000,
               connections: int = 8, **options: str) -> None:
    """Database write in batches; ``overwrite`` replaces the table, ``append`` adds.

    ``connections`` bounds how many tasks write at once.
    """
    df.write.format("jdbc").mode(mode).options(**jdbc_options(url, table, batch, connections, **options)).save()


def write_table(df: DataFrame, fmt: str, mode: str = "append", path: str | None = None, **options: str) -> None:
    """Write through any connector format the session has."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    writer.save(path) if path else writer.save()


def to_json_records(df: DataFrame, ts: str = "text", value: str = "value") -> DataFrame:
    """One strict JSON record per row.

    Times become text, or epoch milliseconds with ``ts='millis'``. NaN and
    infinities become null, and null fields are written out.
    """
    fields = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            column = X.finite_or_null(column)
        elif isinstance(f.dataType, T.TimestampType):
            column = X.to_millis(column) if ts == "millis" else X.format_ts(column)
        fields.append(column.alias(f.name))
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(value))


def topic_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **options}


def write_topic(records: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send JSON records to a topic (needs the Kafka connector on the class path)."""
    records.select("value").write.format("kafka").options(**topic_options(servers, topic, **options)).save()


def convert_once(spark: SparkSession, source: str, target: str, schema: str | None = None) -> bool:
    """CSV to Parquet unless the finished output is already there; tells whether it ran.

    An output without the commit marker is a broken run and is written again.
    """
    if path_exists(spark, f"{target.rstrip('/')}/_SUCCESS"):
        return False
    # A gzip file is read by one task; the rebalance spreads its rows over the writers.
    read_csv(spark, source, schema).hint("rebalance").write.mode("overwrite").parquet(target)
    return True
