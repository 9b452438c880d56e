"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores. A query is warm when it ran once before; the best of the runs after
that counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "c1_top_of_book",
    "d1_dense_index",
    "d6_interpolate",
    "d10_resample_forward_fill",
    "e1_forward_extremes",
    "e2_lookback_windows",
    "e10_level_rank",
    "c4_compress_depth",
    "f5_targets",
    "g5_temporal_features",
    "h7_scale_min_max",
    "j14_profile",
    "j11_depth_heatmap",
    "k6_asof_events",
    "l10_evaluate",
    "n3_context",
)
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        best = None
        for run in range(RUNS + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            if run:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()
