"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from meterline.catalog import load_all
from tools.parity import rows

FOLDER = "/root/testdata/sf0.001"
REGISTRY = load_all()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    q = REGISTRY[name]
    df = q.fn(spark, FOLDER)
    mine = rows(df.columns, df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if q.sql is None:
        assert mine[0]
        return
    cursor = con.execute(q.sql)
    assert mine == rows([d[0] for d in cursor.description], cursor.fetchall())
