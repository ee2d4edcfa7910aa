"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local threads, BENCH_QUERIES an optional comma-separated subset. A query runs up to
three times and its median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from meterline.catalog import load_all
from meterline.session import build_session

HEADLINE = [
    # scans, filters, global and grouped aggregates
    "count_all", "short_trip_count", "count_by_service", "monthly_zone_revenue", "hourly_zone_revenue",
    "longest_trip_per_day", "max_duration_per_day", "distinct_pickup_zones", "distinct_vendors",
    "duplicate_report", "top_dispatch_bases", "trips_per_day", "payment_share",
    # joins
    "zone_revenue_on_day", "max_tip_by_dropoff", "top_zone_pairs", "hourly_green_yellow", "zone_revenue_report",
    # windows
    "top_amounts", "rank_in_zone", "all_ranks", "prev_next", "running_total", "moving_avg",
    "percentile_in_zone", "dedup", "duration_p90",
    # star schema
    "int_trips", "fct_trips", "fct_monthly_zone_revenue", "staging_trips", "trips_report",
    # events
    "tumbling_zone_revenue", "session_zone_count", "session_distinct_times",
    "stream_tumbling_zone_revenue", "stream_session_zone_count",
    # files, checks, stored tables
    "read_csv", "write_months", "row_checks", "materialize_merge_by_day", "predict_duration_query",
]

LONG_ENOUGH = 6.0  # seconds after which a query isn't run again; below, the median of three runs counts


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    registry["count_by_service"].fn(spark, folder).collect()  # start the JVM's workers and codegen once
    times = {}
    for name in names:
        taken = []
        while len(taken) < 3 and sum(taken) < LONG_ENOUGH:
            began = time.perf_counter()
            registry[name].fn(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        times[name] = round(statistics.median(taken), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
