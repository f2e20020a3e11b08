"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  data folder            (default /root/testdata/sf0.1)
BENCH_CPUS    local executor threads (default: all)
BENCH_RUNS    runs per query, the best one counts (default 2)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from stratamart.registry import all_queries

HEADLINE = (
    "fact_sales", "star_sales_by_category_month", "dim_customer", "latest_per_key", "merge_upsert", "merge_pruned",
    "scd2_fold", "scd2_rebuild", "fact_bike_status", "feed_status", "gen_sales", "fk_orphans", "quality_findings",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 1)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("stratamart-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()
