"""File sources: CSV, Parquet, external tables, month ranges, file facts."""

from __future__ import annotations

import os
from collections.abc import Iterable
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schemas
from meterline.operators.columns import normalize_trips
from meterline.operators.sets import concat_frames
from meterline.session import as_timestamps, prepare


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header; gzip by suffix. Without schema or ``infer`` every field is text.

    A declared schema costs no extra pass; ``infer`` reads the files twice.
    """
    reader = prepare(spark).read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, *paths: str, by_name: bool = False) -> DataFrame:
    """Parquet from paths or globs.

    ``by_name`` is for files whose columns differ, under one glob or several. Files whose types agree
    are merged by the reader, whose tasks read the footers. Where a column's type differs from file to file,
    files of equal columns are read together and matched by name, and all take the widest type:
    integers bigint, decimals with integers a decimal that holds both, other numbers double, dates with
    timestamps timestamp, else text. Which files agree is found by merging stretches of them, footers read
    by tasks.
    """
    reader = prepare(spark).read
    if not by_name:
        return as_timestamps(reader.parquet(*paths))
    merged = _mergeable(reader, list(paths))
    if merged is not None:
        return as_timestamps(merged)
    groups: dict[str, list[str]] = {}
    for same, frame in _agreeing(reader, sorted(reader.option("mergeSchema", False).parquet(*paths).inputFiles())):
        groups.setdefault(frame.schema.json(), []).extend(same)
    frames = [as_timestamps(reader.option("mergeSchema", True).parquet(*same)) for same in groups.values()]
    seen: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            seen.setdefault(field.name, []).append(field.dataType)
    target = {name: widest(types) for name, types in seen.items() if len(set(types)) > 1}
    return concat_frames(*[f.withColumns({c: F.col(c).cast(t) for c, t in target.items() if c in f.columns})
                           if target else f for f in frames])


def _mergeable(reader, paths: list[str]) -> DataFrame | None:
    """The files with the union of their columns, or None where a column has two types."""
    try:
        return reader.option("mergeSchema", True).parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    return None


def _agreeing(reader, files: list[str]) -> list[tuple[list[str], DataFrame]]:
    """Files in stretches whose types agree, by halving: columns that changed a few times over a long
    series of files take a few merges, each of them a job whose tasks read the footers."""
    frame = _mergeable(reader, files)
    if frame is not None:
        return [(files, frame)]
    middle = len(files) // 2
    return _agreeing(reader, files[:middle]) + _agreeing(reader, files[middle:])


def widest(types: list[T.DataType]) -> T.DataType:
    """The type that holds the values of all of these."""
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    if all(type(t) in digits for t in types):
        return T.LongType()
    if all(type(t) in digits or isinstance(t, T.DecimalType) for t in types):
        scale = max(t.scale for t in types if isinstance(t, T.DecimalType))
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else digits[type(t)] for t in types)
        return T.DecimalType(min(38, whole + scale), scale)
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType)) for t in types):
        return T.TimestampType()
    return T.StringType()


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Pick the reader by extension."""
    suffix = os.path.splitext(path.removesuffix(".gz"))[1].lower()
    if suffix == ".parquet":
        return read_parquet(spark, path)
    if suffix == ".csv":
        return read_csv(spark, path, infer=True)
    raise ValueError(f"unsupported file format {suffix!r}: use .parquet or .csv")


def external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table over files that stay where they are."""
    prepare(spark).sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    return spark.table(name)


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def seed(spark: SparkSession, name: str, csv: str, schema: str) -> DataFrame:
    """A small typed table from CSV, registered under a name."""
    return register(read_csv(spark, csv, schema), name)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def months_between(start: date | str, end: date | str) -> list[tuple[int, int]]:
    """(year, month) pairs, both ends included."""
    first, last = (date.fromisoformat(str(d)[:10]) for d in (start, end))
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    start_index = first.year * 12 + first.month - 1
    return [divmod(i, 12) for i in range(start_index, start_index + count)] if count > 0 else []


def read_months(spark: SparkSession, base: str, types: Iterable[str], start: date | str, end: date | str,
                max_months: int | None = None, pattern: str = "{type}_tripdata_{year}-{month:02d}.parquet") -> DataFrame:
    """Normalised trips of several services over a month range.

    Missing files are skipped. Months whose files exist are read per service,
    and an empty result still has the normalised columns.
    """
    months = [(y, m + 1) for y, m in months_between(start, end)]
    if max_months is not None and len(months) > max_months:
        raise ValueError(f"{len(months)} months asked for, at most {max_months} per run")
    frames = []
    for kind in types:
        paths = [f"{base.rstrip('/')}/{pattern.format(type=kind, year=y, month=m)}" for y, m in months]
        for path in paths:
            if path_exists(spark, path):
                frames.append(normalize_trips(read_parquet(spark, path), kind))
    if not frames:
        return spark.createDataFrame([], schemas.NORMALISED_TRIPS)
    return concat_frames(*frames)


def with_file_name(df: DataFrame, up: int = 0) -> DataFrame:
    """The name of the file each row comes from, or of the folder that is ``up`` levels above it."""
    name = F.col("_metadata.file_name") if up == 0 else F.element_at(F.split("_metadata.file_path", "/"), -1 - up)
    return df.withColumn("file_name", name)


def file_stats(df: DataFrame) -> DataFrame:
    """Number of files behind a frame and their mean size in MiB."""
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    return files.agg(F.count("*").alias("files"), (F.avg("size") / F.lit(1048576.0)).alias("mean_mib"),
                     (F.sum("size") / F.lit(1048576.0)).alias("total_mib"))
