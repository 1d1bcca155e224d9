"""Time the headline queries; prints one JSON line.

$BENCH_SF_DIR  folder of the test tables   (default /root/testdata/sf0.1)
$BENCH_CPUS    local threads               (default 8)
$BENCH_RUNS    timed runs, best one counts (default 1, after one warm-up)

`build_core` and `refresh_on_arrival` build the whole core layer in every run. The other
queries read a layer built before, as they would in a warehouse.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from martloom.queries import QUERIES, core_layer

HEADLINE = (
    "read_raw_csv",
    "read_raw_csv_breaks",
    "raw_dates",
    "core_raw",
    "product_price",
    "surrogate_key",
    "build_core",
    "fact_sales_build",
    "fact_sales",
    "fact_sales_shared_all",
    "mart_sales_by_year",
    "mart_sub_category_sales",
    "check_primary_key",
    "reconciliation_strict",
    "refresh_on_arrival",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("martloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="martloom-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for variant, strict in (("plain", False), ("shared_all", False), ("shared_all", True)):
        core_layer(spark, folder, variant, strict).tables()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
