"""Time the headline queries; prints one JSON line.

Each query is run once to warm up and then BENCH_RUNS times; the median counts. Results are
written to Spark's ``noop`` sink, so that every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from table_queries.queries import REGISTERED  # noqa: E402

HEADLINE = [
    "daily_invoice_report", "invoice_line_join", "nested_flatten", "cancellations", "merge_chain", "split_root",
    "fill_both_ways", "lifo_netting", "occurrence_join", "first_per_invoice", "split_replay", "order_reconstruction",
    "staff_order", "staff_kpi", "customer_invoice", "item_velocity", "price_override", "close_time", "cancel_outliers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        # One file per table: without this a scan would be a single task.
        .config("spark.sql.files.maxPartitionBytes", str(4 << 20))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    line = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
