import pytest
from pyspark.sql import functions as F

from meterline.operators import quality as Q


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0), (1, None, -1.0), (None, "z", 0.0), (3, "b", None)], "id int, kind string, amount double")


def test_row_checks_share_one_pass(spark, table):
    checks = [Q.not_null("id"), Q.accepted_values("kind", ["a", "b"]), Q.non_negative("amount"), Q.positive("amount")]
    result = Q.run_checks(table, checks)
    assert result.failing == {"not_null(id)": 1, "accepted_values(kind)": 1, "non_negative(amount)": 1,
                              "positive(amount)": 2}
    plan = Q.check_counts(table, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_table_checks(spark, table):
    parent = spark.createDataFrame([(1,), (None,)], "key int")
    table.createOrReplaceTempView("quality_table")
    result = Q.run_checks(table, [Q.unique("id"), Q.unique_combination(["id", "kind"]),
                                  Q.relationships("id", parent, "key"),
                                  Q.query_equals(spark, "SELECT count(*) FROM quality_table", 4)])
    assert result.failing == {"unique(id)": 1, "unique_combination(id,kind)": 0, "relationships(id)": 1,
                              "query_equals(select ... = 4)": 0}


def test_every_failure_is_reported(spark, table):
    with pytest.raises(ValueError) as error:
        Q.run_checks(table, [Q.not_null("id"), Q.unique("id"), Q.required_columns(["id", "fare"])]).raise_on_failure()
    for part in ("not_null(id): 1", "unique(id): 1", "missing fare"):
        assert part in str(error.value)
    Q.run_checks(table, [Q.accepted_values("kind", ["a", "b", "z"])]).raise_on_failure()


def test_contract_and_drift(spark, table):
    assert Q.run_checks(table, [Q.contract("kind string, amount double, id int")]).failed() == []
    assert Q.run_checks(table, [Q.contract("id bigint, kind string")]).problems["contract"] == [
        "unexpected amount", "id is int, not bigint"]
    with pytest.raises(ValueError, match="missing amount"):
        Q.schema_unchanged(table, table.drop("amount"))


def test_strict_json_counts_bare_nan(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": NaN}',), ('{"a": ',), ('{"a": null}',)], "value string")
    assert tuple(Q.strict_json(df, "value", "a double").first()) == (4, 2)


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-10",)], "d string").select(F.to_timestamp("d").alias("t"))
    assert Q.run_checks(df, [Q.freshness(df, "t", "2024-01-12", "3 days")]).failed() == []
    assert Q.run_checks(df, [Q.freshness(df, "t", "2024-02-12", "3 days")]).failed() == ["freshness(t)"]


def test_checks_of_nothing(spark):
    empty = spark.createDataFrame([], "t timestamp, x int")
    assert Q.run_checks(empty, [Q.freshness(empty, "t", "2024-01-12", "3 days")]).failed() == ["freshness(t)"]
    assert Q.run_checks(empty, [Q.query_equals(spark, "SELECT 1 WHERE false", 1)]).failed()
    assert Q.check_counts(empty, []).count() == 0
