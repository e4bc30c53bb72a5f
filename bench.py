"""Times the queries on local cores and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES a comma-separated choice.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from storeloom.catalog import QUERIES
from storeloom.session import build_session

HEADLINE = [
    "fact_sales",
    "fact_sales_lines",
    "burn_rate",
    "login_purchase_correlations",
    "rfm",
    "top_spender",
    "product_sales_category",
    "customer_gender_sales",
    "dim_customers",
    "dim_orders",
    "dim_products",
    "dim_order_items",
    "fact_login_attempts",
    "insert_if_absent",
    "land_order_items",
    "land_customers_csv",
    "land_login_attempts_json",
    "activities_synthetic",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "storeloom-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One run before the clock starts, so that the first time is not the start of the JVM.
    QUERIES["top_spender"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    report = {
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
