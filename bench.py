"""Time the headline queries; prints one JSON line.

Cleansed tables and dimensions are stored once and timed as ``store_...``; facts
read them from there, as in the lakehouse itself.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES, stored_dim, stored_silver  # noqa: E402

PREPARED = {
    **{f"store_silver_{n}": (stored_silver, n) for n in ("pos", "erp", "sensor")},
    **{
        f"store_dim_{n}": (stored_dim, n)
        for n in ("date", "store", "product", "customer", "supplier")
    },
}

HEADLINE = [
    "margin",
    "daily_sales",
    "sales",
    "sales_shuffled",
    "purchase_orders",
    "iot_readings",
    "silver_pos",
    "silver_erp",
    "silver_sensor",
    "validate_dims",
    "validate_facts",
    "change_feed",
    "merge_full",
    "merge_append",
    "bronze_pos",
    "stream_pos",
    "stream_iot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shoplake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up: start the session's code paths before the first timed query.
    QUERIES["dim_date"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name, (build, table) in PREPARED.items():
        start = time.perf_counter()
        build(spark, sf_dir, table)
        seconds[name] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
