import random

import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("source", T.StringType())])
# columns that operators use inside, under other meanings
CLASHING = ["id", "n", "key", "hash", "digest", "slot", "block", "place", "row", "score", "ranges", "n_bytes", "uid"]


@pytest.fixture(scope="session")
def docs(spark):
    """A documents frame of (doc_id, text) or (doc_id, text, source) rows, with columns of clashing names."""
    def make(rows, clash=False):
        frame = spark.createDataFrame([(*r, None)[:3] for r in rows], DOC)
        return frame.selectExpr("*", *(f"'x' AS {c}" for c in CLASHING)) if clash else frame
    return make


@pytest.fixture
def prose():
    """Texts of invented words, the same for the same seed."""
    def make(n_words, seed):
        r = random.Random(seed)
        return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n_words))
    return make
