"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only a purely local session may do without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="meterline-llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: later jobs and lost executors start from the files.

    The files stay until the shared folder is expired, since the frame returned is lazy.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of jobs that have ended: Spark deletes them once the driver's collector found them unused.

    The first collection frees the frames, the second the shuffles that only they referred to.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def forget(df: DataFrame) -> None:
    """Delete the files of a stored frame that no later frame reads."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def free(name: str, taken: list[str]) -> str:
    """The name, lengthened until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name
