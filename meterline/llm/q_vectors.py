"""Queries over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.llm import grid_join, topk
from meterline.llm.queries import query
from meterline.llm.storage import table

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


@query("op3_exact_top_k", TOP_K_SQL)
def op3(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=64)


@query("op9_embedding_near_dedup")
def op9(spark, folder):
    return grid_join.near_vectors(table(spark, folder, "embeddings"), least=0.95)
