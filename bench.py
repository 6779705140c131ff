"""Time the headline operators on one machine; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Every time is the median of three
runs after a warm-up run. Results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from zonemill.layout import PARTITION_MONTH  # noqa: E402
from zonemill.functions.clean import with_partition_month  # noqa: E402
from zonemill.operators.merge import merge_upsert  # noqa: E402
from zonemill.plans.registered import LINE_ORDER, QUERIES, table  # noqa: E402
from zonemill.session import work_dir  # noqa: E402
from zonemill.sources.datasets import read_table, write_dataset  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
# A tenth of the rows is delivered again and another tenth is new.
DELIVERED_FROM, LOADED_BEFORE = "2000-04-08", "2000-12-04"

REGISTERED = [
    "merge_orders",
    "merge_null_keys",
    "merge_audit",
    "merge_touched_months",
    "delete_window_rows",
    "missing_customers",
    "compact_events",
    "latest_event_per_user",
    "conform_types",
    "ingest_deliveries",
    "ingest_backlog",
    "purge_rows",
]


def merge_tenth(spark: SparkSession, name: str, date: str, value: str, keys: list[str], **options: object) -> DataFrame:
    rows = table(spark, SF_DIR, name)
    delivery = rows.filter(F.col(date) >= DELIVERED_FROM).withColumn(value, F.col(value) * 2)
    return merge_upsert(rows.filter(F.col(date) < LOADED_BEFORE), delivery, keys, **options)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("zonemill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    by_month = work_dir(spark, "orders")
    orders = with_partition_month(table(spark, SF_DIR, "orders"), "o_orderdate")
    write_dataset(orders, by_month, partition_by=PARTITION_MONTH)
    line_keys = ["l_orderkey", "l_linenumber"]
    latest = {"on_duplicate": "latest", "order_by": LINE_ORDER}
    timed = {
        "merge_tenth_orders": lambda: merge_tenth(spark, "orders", "o_orderdate", "o_totalprice", ["o_orderkey"]),
        "merge_tenth_lineitem": lambda: merge_tenth(spark, "lineitem", "l_shipdate", "l_tax", line_keys, **latest),
        "scan_one_month": lambda: read_table(spark, by_month, PARTITION_MONTH, "1998-10"),
        "scan_all_months": lambda: read_table(spark, by_month),
        **{name: (lambda n=name: QUERIES[n](spark, SF_DIR)) for name in REGISTERED},
    }
    seconds = {}
    for name, build in timed.items():
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
