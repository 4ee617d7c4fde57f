"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma-separated names, default the headline set) steer it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegauge.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "psi", "js_divergence", "ks_statistic", "wasserstein", "chi2_statistic", "drift_report_windows", "drift_report_segments",
    "aa_random_floor", "aa_random_floor_grid", "aa_block_floor", "calibration_record", "homogeneity_by_feature",
    "performance_by_window", "best_mcc_threshold", "extended_metrics", "decisions", "monitor_backfill", "time_axis",
    "feature_profile", "feature_selection", "artefact_checks", "range_violation", "wear_guard", "planted_drift",
    "stream_window_monitor", "adwin",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["sliding_windows"](spark, directory).write.format("noop").mode("overwrite").save()  # warm the session
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
