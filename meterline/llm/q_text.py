"""Queries over the documents table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from meterline.llm import anchors, backoff_lm, filter_audit, importance, licences, mixing, near, packing, quality, repeats
from meterline.llm.queries import query
from meterline.llm.storage import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the vocabulary of byte_bpe_50k.json, same ids


@query("op2_best_fit_packing")
def op2(spark, folder):
    return packing.pack(table(spark, folder, "documents"), RANKS, length=1024, end_id=2)


@query("op4_quality_classifier")
def op4(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fitted(docs, table(spark, folder, "labels"))
    scored = quality.score(docs, model).drop("text")
    return scored.select("doc_id", quality.held_out("doc_id", 5).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op7_minhash_near_dedup")
def op7(spark, folder):
    return near.near_duplicates(table(spark, folder, "documents"), percent=75, words=5)


@query("op6_pfair_mixing", mixing.MIX_SQL.format(block=64))
def op6(spark, folder):
    return mixing.interleave(table(spark, folder, "documents").select("doc_id", "source"), block=64)


@query("op1_license_scan", licences.scan_sql())
def op1(spark, folder):
    return licences.scan(table(spark, folder, "documents"), licences.known_digests(spark))


@query("op8_lm_scoring")
def op8(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = backoff_lm.score(docs, ~quality.held_out("doc_id", 10))
    return scored.select("doc_id", quality.held_out("doc_id", 10).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@query("op5_suffix_array_dedup")
def op5(spark, folder):
    cut = repeats.cut_texts(table(spark, folder, "documents").select("doc_id", "text"), length=200)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@query("op11_importance_resampling", importance.SQL)
def op11(spark, folder):
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"), percent=5, least_words=20,
                               seed=42, buckets=10000)


@query("op12_filter_audit", filter_audit.SQL)
def op12(spark, folder):
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"), part="lang")


@query("op13_substring_dedup", anchors.SQL)
def op13(spark, folder):
    cut = anchors.cut_texts(table(spark, folder, "documents").select("doc_id", "text"), length=20)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
