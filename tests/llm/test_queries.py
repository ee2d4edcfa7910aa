"""The registered queries on the smallest tables: those with SQL against it, the others by their columns."""

import glob
import os

import duckdb
import pytest

from meterline.llm import queries as registry
from tools.parity import rows

FOLDER = "/root/testdata/sf0.001"
registry.load()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

COLUMNS = {
    "op2": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op5": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op7": ["doc_id", "n_shingles", "component_id", "kept"],
    "op8": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op9": ["vec_id", "n_links", "component_id", "kept"],
    "op10": ["page_id", "url", "text", "n_chars"],
}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = registry.QUERIES[name](spark, FOLDER)
    cursor = con.execute(registry.ORACLE[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_columns(spark, name):
    assert registry.QUERIES[name](spark, FOLDER).columns == COLUMNS[name.split("_")[0]]
