"""Time the registered queries: one warm-up and the median of three runs each; prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of threads, BENCH_RUNS the number of timed runs and
BENCH_QUERIES (comma-separated) the queries, by default all headline queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillmark.plans.registry import QUERIES  # noqa: E402
from tillmark.session import get_spark  # noqa: E402

HEADLINE = (
    "transactions_valid transactions_quarantine products_bronze dim_date dim_customers dim_products dim_geography "
    "fct_sales product_quantity_stats quantity_outliers missing_country_refs alert_digest sales_by_day top_products "
    "sales_by_country top_customers trending_products trending_streaming ingest_incremental"
).split()


def run(spark, name: str, folder: str) -> float:
    """Seconds to compute the whole result; the rows are thrown away where they are made."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = get_spark(
        "tillmark-bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, folder)
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
