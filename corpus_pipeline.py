"""From raw documents to packed training sequences, stage by stage.

Every stage takes what the one before kept and, but for the last, returns the columns of ``documents``. Null and
empty texts pass all stages; null ids take part in none of the comparisons and pass as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm import mixing, near, packing, quality, repeats
from meterline.llm.q_text import RANKS
from meterline.llm.storage import free, stored, table

KEEP_FROM = 0.3  # quality score


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    model = quality.fitted(docs, table(spark, sf_dir, "labels"))
    score = free("quality_score", docs.columns)
    return quality.score(docs, model, score).where(F.col(score) >= KEEP_FROM).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; a row repeated with its id and text stays once, rows without id stay."""
    kept = near.near_duplicates(docs).groupBy("doc_id").agg(F.every("kept").alias("kept")).where("kept").select("doc_id")
    known = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return known.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes and more that occur elsewhere too; no document goes."""
    cut = repeats.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: the files, read one after the other, follow the schedule."""
    _, slot, place = added = tuple(free(c, docs.columns) for c in ("block", "slot", "place"))
    placed = mixing.interleave(docs, added=added)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartitionByRange(tasks, slot, place).sortWithinPartitions(slot, place).drop(*added)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 1024 tokens, numbered in the order in which the mix comes to them."""
    file, row, before, place = (free(c, docs.columns) for c in ("file", "row", "before", "place"))
    rows = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    sizes = rows.groupBy(file).agg(F.count("*").alias(before))  # a row per file
    ends = sizes.withColumn(before, F.sum(before).over(Window.orderBy(file)) - F.col(before))
    ordered = rows.join(F.broadcast(ends), file).withColumn(place, F.col(before) + F.col(row))
    return packing.pack(ordered, RANKS, length=1024, end_id=2, order=place)


STAGES = [
    ("quality_classifier", keep_quality),
    ("minhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", drop_repeats),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None  # votes among vectors and packing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
