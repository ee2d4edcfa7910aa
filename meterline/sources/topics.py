"""Topic sources. The connector format is a parameter; everything after it is the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.session import prepare


def topic_source_options(servers: str, topic: str, start: str = "earliest", end: str | None = None,
                         **options: str) -> dict[str, str]:
    if start not in ("earliest", "latest"):
        raise ValueError("start is 'earliest' or 'latest'")
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if end is not None:
        out["endingOffsets"] = end
    return {**out, **options}


def read_topic_bounded(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """All partitions from the first record to the ends seen when the read starts."""
    wanted = topic_source_options(servers, topic, "earliest", "latest", **options)
    return (prepare(spark).read.format("kafka").options(**wanted).load()
            .selectExpr("CAST(value AS STRING) AS value"))


def stream_topic(spark: SparkSession, servers: str, topic: str, start: str = "earliest", **options: str) -> DataFrame:
    """Unbounded record stream from the first or from new records only."""
    wanted = topic_source_options(servers, topic, start, **options)
    return (prepare(spark).readStream.format("kafka").options(**wanted).load()
            .selectExpr("CAST(value AS STRING) AS value"))


def read_record_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed records, one JSON text per line, as a bounded topic would give them."""
    return prepare(spark).read.text(path)


def stream_record_files(spark: SparkSession, path: str, start: str = "earliest",
                        files_per_batch: int | None = None) -> DataFrame:
    """Landed records as a stream; each new file is new input.

    ``start='latest'`` takes the newest files first. A file source has no
    position to skip to, so earlier files still follow.
    """
    reader = prepare(spark).readStream.option("latestFirst", start == "latest")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
