"""Nested JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import prepare


def read_json_docs(spark: SparkSession, path: str, selector: str, schema: str | None = None,
                   multi_line: bool = True) -> DataFrame:
    """Rows found under a list field of each JSON document.

    With ``multi_line`` off, each text line is a document and files can be split.
    """
    reader = prepare(spark).read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path).select(F.explode(selector).alias("_doc")).select("_doc.*")
