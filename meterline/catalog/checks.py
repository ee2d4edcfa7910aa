"""Data checks over the trip tables, as (check, failing) rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.catalog import query
from meterline.catalog.common import over
from meterline.fixtures import events, trips, zones
from meterline.operators import quality as Q
from meterline.operators.joins import orphans
from meterline.session import load_table
from meterline.sinks.files import to_json_records
from meterline.sources.files import register


@query("Q01 Q03 Q06", over("""
SELECT 'not_null(known_vendor)' AS "check", count(*) FILTER (source_part % 17 = 0) AS failing FROM trips UNION ALL
SELECT 'accepted_values(payment_type)', count(*) FILTER (payment_type NOT IN (1, 2, 3, 4)) FROM trips UNION ALL
SELECT 'accepted_values(service_type)', count(*) FILTER (service_type NOT IN ('Green', 'Yellow')) FROM trips UNION ALL
SELECT 'non_negative(margin)', count(*) FILTER (fare_amount - 1000 < 0) FROM trips UNION ALL
SELECT 'positive(tip_amount)', count(*) FILTER (tip_amount <= 0) FROM trips"""))
def row_checks(spark, folder):
    """Five checks, one pass over the table."""
    rows = trips(spark, folder).withColumns({
        "known_vendor": F.when(F.col("source_part") % 17 != 0, F.col("vendor_id")),
        "margin": F.col("fare_amount") - 1000})
    return Q.check_counts(rows, [
        Q.not_null("known_vendor"), Q.accepted_values("payment_type", [1, 2, 3, 4]),
        Q.accepted_values("service_type", ["Green", "Yellow"]), Q.non_negative("margin"), Q.positive("tip_amount")])


@query("Q02 Q05", """
SELECT 'unique(l_orderkey)' AS "check", count(*) AS failing FROM (
  SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1) UNION ALL
SELECT 'unique_combination(l_orderkey,l_linenumber)', count(*) FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def unique_checks(spark, folder):
    return Q.check_counts(load_table(spark, folder, "lineitem"), [
        Q.unique("l_orderkey"), Q.unique_combination(["l_orderkey", "l_linenumber"])])


@query("Q04", over("""
SELECT 'relationships(pickup_location_id)' AS "check", count(*) AS failing
FROM trips WHERE pickup_location_id >= 20"""))
def relationship_check(spark, folder):
    return Q.check_counts(trips(spark, folder), [
        Q.relationships("pickup_location_id", zones(spark, folder, 20), "LocationID")])


@query("J08", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F')""")
def orphan_rows(spark, folder):
    open_orders = load_table(spark, folder, "orders").filter("o_orderstatus <> 'F'")
    lines = load_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return orphans(lines, "l_orderkey", open_orders, "o_orderkey")


@query("Q07", """SELECT 'query_equals(select ... = 1)' AS "check", CAST(0 AS BIGINT) AS failing
WHERE (SELECT count(*) FROM orders) > 0""")
def query_check(spark, folder):
    register(load_table(spark, folder, "orders"), "meterline_orders")
    return Q.check_counts(load_table(spark, folder, "orders"), [
        Q.query_equals(spark, "SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM meterline_orders", 1)])


@query("Q11 X16", """
SELECT count(*) AS records, count(*) FILTER (event_id % 100 = 7) AS invalid FROM events""")
def strict_json(spark, folder):
    """Records of which every hundredth carries a bare NaN."""
    records = to_json_records(events(spark, folder).select("event_id", "value"))
    number = F.get_json_object("value", "$.event_id").cast("bigint")
    mixed = records.select(F.when(number % 100 == 7, F.regexp_replace("value", '"value":.*', '"value":NaN}'))
                           .otherwise(F.col("value")).alias("value"))
    return Q.strict_json(mixed, "value", "event_id bigint, value double")


@query("Q14", """
SELECT 'freshness(ts)' AS "check", CAST(CASE WHEN max(ts) < TIMESTAMP '2024-02-05' - INTERVAL '3 days'
       THEN count(*) ELSE 0 END AS BIGINT) AS failing FROM events""")
def freshness_check(spark, folder):
    rows = events(spark, folder)
    return Q.check_counts(rows, [Q.freshness(rows, "ts", "2024-02-05", "3 days")])


@query("Q13 Q15", over("""
SELECT name AS "check", failing, failing > 0 AS failed, true AS stopped FROM (
  SELECT 'not_null(pickup_datetime)' AS name, count(*) FILTER (pickup_datetime IS NULL) AS failing FROM trips UNION ALL
  SELECT 'accepted_values(payment_type)', count(*) FILTER (payment_type NOT IN (1, 2)) FROM trips UNION ALL
  SELECT 'required_columns', CAST(1 AS BIGINT))"""))
def run_checks(spark, folder):
    """All checks are evaluated, then the run stops, here for wrong values and a missing column; the report stands."""
    results = Q.run_checks(trips(spark, folder), [
        Q.not_null("pickup_datetime"), Q.accepted_values("payment_type", [1, 2]), Q.required_columns(["vendor_id", "ehail_fee"])])
    try:
        stopped = results.raise_on_failure() is None
    except ValueError:
        stopped = True
    found = {**results.failing, **{name: len(problems) for name, problems in results.problems.items()}}
    return spark.createDataFrame([(name, n, name in results.failed(), stopped) for name, n in found.items()],
                                 "check string, failing bigint, failed boolean, stopped boolean")
