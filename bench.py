"""Time every registered query and print one JSON line.

BENCH_SF_DIR    directory of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS      local threads (default 8)
BENCH_RUNS      timed runs per query after one warm-up, the median counts (default 3)
BENCH_QUERIES   comma-separated names (default all)

A run builds the query and writes every row to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bazaarlens.plans import QUERIES  # noqa: E402


def run(spark: SparkSession, name: str, directory: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names.split(",") if names else QUERIES:
        run(spark, name, directory)
        times[name] = round(statistics.median(run(spark, name, directory) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
