"""Starting streams: checkpoints, triggers and sinks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from meterline.sinks.files import write_jdbc
from meterline.sinks.materialize import materialize


def _trigger(interval: str | None) -> dict:
    """A checkpoint every ``interval``, or all input present now and then stop."""
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def start(df: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds",
          fmt: str = "parquet") -> StreamingQuery:
    """Append closed windows or plain rows to files; each row is written once."""
    return (df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**_trigger(interval)).start(path))


def stream_to_jdbc(df: DataFrame, url: str, table: str, checkpoint: str, interval: str | None = "10 seconds",
                   **options: str) -> StreamingQuery:
    """Append every micro-batch to a database table. A batch retried after a failure
    may be written twice; use ``stream_upsert`` where rows have a key."""
    def write(batch: DataFrame, _batch_id: int) -> None:
        write_jdbc(batch, url, table, mode="append", **options)
    return (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**_trigger(interval)).foreachBatch(write).start())


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's own name, which its checkpoint keeps over restarts."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def _stored_batches(df: DataFrame, target: str, strategy: str, checkpoint: str, interval: str | None, mode: str,
                    keys: list[str] | None = None, day_of: str | None = None) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        if not materialize(batch, target, strategy, keys=keys, day_of=day_of,
                           batch=(_query_id(batch.sparkSession, checkpoint), batch_id)):
            batch.write.format("noop").mode("overwrite").save()  # the stream's own state still needs the batch
    return (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**_trigger(interval)).foreachBatch(write).start())


def stream_append(df: DataFrame, target: str, checkpoint: str, interval: str | None = "10 seconds",
                  day_of: str | None = None) -> StreamingQuery:
    """Add every micro-batch to a stored table. A batch retried after a failure is skipped
    if the table already has it."""
    return _stored_batches(df, target, "append", checkpoint, interval, "append", day_of=day_of)


def stream_upsert(df: DataFrame, target: str, keys: list[str], checkpoint: str, interval: str | None = "10 seconds",
                  mode: str = "update", day_of: str | None = None, whole_table: bool = False) -> StreamingQuery:
    """Keep a stored table keyed on ``keys``: a later row of a key replaces the earlier.

    With ``day_of`` only the dates a batch touches are rewritten. Without it every batch rewrites the
    whole table, which only small result tables bear, so ``whole_table`` must ask for it.
    A batch the table already has is skipped.
    """
    if day_of is None and not whole_table:
        raise ValueError("name the timestamp in day_of, or accept with whole_table that every batch rewrites the table")
    return _stored_batches(df, target, "merge", checkpoint, interval, mode, keys, day_of)
