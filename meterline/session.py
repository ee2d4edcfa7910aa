"""Session set-up: UTC time, timestamp reading, the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Needed for right results, so set on every session the library touches.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Files without a zone marker load as TIMESTAMP: watermarks need that type,
    # and without a cast over the column the filters still reach the scan.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
}

# Defaults of sessions the library builds itself. On a cluster the submitter's
# own values win; AQE then sizes the shuffles from the real data.
BUILD_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    # Recording the Python line of every column expression costs more than planning it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "meterline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**BUILD_CONF, **SEMANTIC_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Put the settings results depend on onto a session made elsewhere."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="meterline-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def work_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier call has used."""
    return f"{shared_folder(spark).rstrip('/')}/meterline/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    Used where several actions need the same intermediate result.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_timestamps(df: DataFrame) -> DataFrame:
    """Turn zone-free timestamp columns into TIMESTAMP, leaving all others alone."""
    free = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in free}) if free else df


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A read-only Parquet table of a folder."""
    return as_timestamps(prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet"))
