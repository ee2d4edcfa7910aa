"""Ranking, neighbour, running and percentile queries over trips."""

from __future__ import annotations

from meterline.catalog import query
from meterline.catalog.common import over, rounded
from meterline.fixtures import TIE_BREAK, trips
from meterline.operators import windows as W
from meterline.plans import reports as R

_TIES = ", ".join(TIE_BREAK)
_ROW = "pickup_location_id, total_amount, source_order, source_line, source_part, source_supplier"


def _amounts(spark, folder, *more: str):
    return trips(spark, folder).select("pickup_location_id", "total_amount", *more, *TIE_BREAK)


@query("W01 O04", over(f"""
SELECT total_amount, ranking FROM (
  SELECT total_amount, row_number() OVER (ORDER BY total_amount DESC, {_TIES}) AS ranking FROM trips)
WHERE ranking <= 10"""))
def top_amounts(spark, folder):
    return W.top_amounts(_amounts(spark, folder), "total_amount", TIE_BREAK, 10).select("total_amount", "ranking")


@query("W02", over(f"""
SELECT {_ROW}, row_number() OVER (PARTITION BY pickup_location_id ORDER BY total_amount DESC, {_TIES}) AS ranking
FROM trips"""))
def rank_in_zone(spark, folder):
    return W.rank_in_group(_amounts(spark, folder), ["pickup_location_id"], "total_amount", TIE_BREAK)


_RANKS_SQL = f"""
SELECT pickup_location_id, {{value}}, {_TIES},
  row_number() OVER (PARTITION BY pickup_location_id ORDER BY {{value}} DESC, {_TIES}) AS "row_number",
  rank() OVER (PARTITION BY pickup_location_id ORDER BY {{value}} DESC) AS "rank",
  dense_rank() OVER (PARTITION BY pickup_location_id ORDER BY {{value}} DESC) AS "dense_rank"
FROM trips"""


@query("W03", over(_RANKS_SQL.format(value="trip_distance")))
def all_ranks(spark, folder):
    rows = trips(spark, folder).select("pickup_location_id", "trip_distance", *TIE_BREAK)
    return W.all_ranks(rows, ["pickup_location_id"], "trip_distance", TIE_BREAK)


@query("W04", over(f"""
SELECT pickup_location_id, pickup_datetime, total_amount, {_TIES},
  lag(total_amount) OVER w AS prev_total_amount, lead(total_amount) OVER w AS next_total_amount
FROM trips WINDOW w AS (PARTITION BY pickup_location_id ORDER BY pickup_datetime, {_TIES})"""))
def prev_next(spark, folder):
    return W.prev_next(_amounts(spark, folder, "pickup_datetime"), ["pickup_location_id"],
                       ["pickup_datetime", *TIE_BREAK], "total_amount")


@query("W04", over(f"""
SELECT pickup_datetime, total_amount, {_TIES},
  lag(total_amount, 2) OVER w AS prev_total_amount, lead(total_amount, 2) OVER w AS next_total_amount
FROM trips WINDOW w AS (ORDER BY pickup_datetime, {_TIES})"""))
def prev_next_overall(spark, folder):
    """No key at all: the whole table is one group, cut into blocks by place."""
    rows = _amounts(spark, folder, "pickup_datetime").drop("pickup_location_id")
    return W.prev_next(rows, [], ["pickup_datetime", *TIE_BREAK], "total_amount", offset=2)


@query("W05", over(f"""
SELECT pickup_location_id, pickup_datetime, total_amount, {_TIES},
  round(sum(total_amount) OVER (PARTITION BY pickup_location_id ORDER BY pickup_datetime, {_TIES}
        ROWS UNBOUNDED PRECEDING), 2) AS running_total
FROM trips"""))
def running_total(spark, folder):
    out = W.running_total(_amounts(spark, folder, "pickup_datetime"), ["pickup_location_id"],
                          ["pickup_datetime", *TIE_BREAK], "total_amount", "running_total")
    return rounded(out, 2, "running_total")


@query("W06", over(f"""
SELECT pickup_location_id, pickup_datetime, total_amount, {_TIES},
  round(avg(total_amount) OVER (PARTITION BY pickup_location_id ORDER BY pickup_datetime, {_TIES}
        ROWS 6 PRECEDING), 5) AS moving_avg
FROM trips"""))
def moving_avg(spark, folder):
    out = W.moving_avg(_amounts(spark, folder, "pickup_datetime"), ["pickup_location_id"],
                       ["pickup_datetime", *TIE_BREAK], "total_amount", "moving_avg", 6)
    return rounded(out, 5, "moving_avg")


@query("W07", over(f"""
SELECT {_ROW}, round(quantile_cont(total_amount, 0.9) OVER (PARTITION BY pickup_location_id), 4) AS p90
FROM trips"""))
def percentile_in_zone(spark, folder):
    out = W.percentile_in_group(_amounts(spark, folder), ["pickup_location_id"], "total_amount", 0.9, "p90")
    return rounded(out, 4, "p90")


@query("W08 F13", over(f"""
SELECT vendor_id, pickup_datetime, pickup_location_id, service_type, dropoff_datetime, {_TIES} FROM (
  SELECT *, row_number() OVER (PARTITION BY vendor_id, pickup_datetime, pickup_location_id, service_type
                               ORDER BY dropoff_datetime, {_TIES}) AS rn FROM trips) WHERE rn = 1"""))
def dedup(spark, folder):
    rows = trips(spark, folder).select("vendor_id", "pickup_datetime", "pickup_location_id", "service_type",
                                       "dropoff_datetime", *TIE_BREAK)
    return W.dedup(rows, ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"],
                   ["dropoff_datetime", *TIE_BREAK])


@query("W09 F13", over("""
SELECT pickup_datetime, total_amount, "rank" FROM (
  SELECT pickup_datetime, total_amount, rank() OVER (ORDER BY total_amount DESC) AS "rank" FROM trips)
WHERE "rank" = 2"""))
def nth_largest(spark, folder):
    rows = trips(spark, folder).select("pickup_datetime", "total_amount")
    return W.nth_largest(rows, "total_amount", 2)


@query("W10 X06", over("""
SELECT pickup_location_id, trip_duration,
       round(quantile_cont(trip_duration, 0.9) OVER (PARTITION BY pickup_location_id), 4) AS trip_duration_p90
FROM (SELECT pickup_location_id, date_diff('second', pickup_datetime, dropoff_datetime) AS trip_duration FROM trips)
"""))
def duration_p90(spark, folder):
    return rounded(R.duration_p90(trips(spark, folder)), 4, "trip_duration_p90")
