"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (folder of the tables), BENCH_CPUS, BENCH_RUNS (timed runs per
query, the best counts), BENCH_QUERIES (comma-separated names).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from punctual.session import session  # noqa: E402
from punctual.verification.queries import registered  # noqa: E402

HEADLINE = [
    "fact_events",
    "otp_by_scope",
    "otp_by_scope_star",
    "daily_performance",
    "hourly_delay_categories",
    "delay_histogram",
    "train_spans",
    "station_presence",
    "timetable_coverage",
    "station_performance",
    "pair_comparison",
    "period_metrics",
    "route_station_top10",
    "hourly_pattern_stddev",
    "rush_hour",
    "weekend_summary",
    "rankings_range",
    "consistency_median_star",
    "fact_rush",
    "region_delay",
    "station_star",
    "dedup_latest_version",
    "nest_unnest_roundtrip",
    "raw_train_statistics",
    "reload_idempotent",
    "dq_report",
    "pruned_read",
    "lake_weather_punctuality",
    "gold_reload",
    "stored_otp_by_scope",
    "stored_period_metrics",
    "stored_rush_hour",
    "stored_weekend_summary",
    "stored_rankings_range",
]


def run_once(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    seconds = {}
    for name in names:
        run_once(spark, queries[name], folder)  # warms up the JVM, not counted
        seconds[name] = round(min(run_once(spark, queries[name], folder) for _ in range(runs)), 3)
    found = re.search(r"sf([0-9.]+)", folder)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else folder,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
