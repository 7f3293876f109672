"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
BENCH_QUERIES  comma-separated names; default is the list below, "all" runs every one
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from obsframe.plans.session import configure  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = (
    "p10_process_logs", "p12_filter_by_target", "p16_validate_books", "p18_parse_ingestion",
    "j1_enrich_books", "j2_match_routes", "j3_inject_errors", "j4_link_ingestion",
    "j5_service_edges", "j6_correlate_errors_parent", "j7_logs_for_traces", "j8_telemetry_coverage",
    "j9_apply_changes", "a1_span_calls", "a2_span_latency", "a3_service_graph", "a4_red_summary",
    "a5_log_count", "a10_active_requests", "a11_sum_by", "a12_quantile_over_time", "a13_exemplars",
    "w1_delta_to_cumulative", "w2_rate", "w3_error_rate", "w4_latency_heatmap", "w7_alert_states",
    "w8_attach_breadcrumbs", "w7_error_alert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("obsframe-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="obsframe-warehouse-"))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    calibration = []
    for _ in range(runs + 1):  # the same work on any data: tells a slow machine from a slow query
        began = time.perf_counter()
        spark.range(0, 50_000_000, 1, int(cpus)).selectExpr("sum(xxhash64(id) % 1000)").collect()
        calibration.append(time.perf_counter() - began)
    times: dict[str, float] = {}
    for name in names:
        measured = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - began)
        times[name] = round(statistics.median(measured[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(os.path.normpath(sf_dir)),
        "calibration": round(statistics.median(calibration[1:]), 3),
    }))


if __name__ == "__main__":
    main()
