"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from basketry.plans import refresh
from basketry.plans.warehouse import Warehouse
from basketry.registry.queries import GROWTH, QUERIES, VIP
from basketry.session import fresh_path, get_session
from basketry.sources import from_star

HEADLINE = [
    "order_metrics",
    "customer_lifetime",
    "customer_segment_performance",
    "mart_product_performance",
    "primary_product",
    "fct_orders",
    "daily_revenue_summary",
    "unified_transactions",
    "monthly_segment_metrics",
    "product_segment_performance",
    "customer_ltv_by_category",
    "ltv_statistics",
    "segment_product_analysis",
    "check_return_dates",
    "quality_report",
    "product_cost_history",
    "daily_revenue_stream",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def refresh_ratio(spark, folder: str) -> dict[str, float]:
    """Full load of the fact table against a refresh of its last 14 days."""
    wh = Warehouse(from_star(spark, folder), VIP, GROWTH)
    customers = wh.dim_customers
    path = fresh_path(spark, "bench-facts")
    full = timed(lambda: refresh.refresh_fct_orders(path, wh.staged, customers))
    again = timed(lambda: refresh.refresh_fct_orders(path, wh.staged, customers))
    return {"facts_full_load": full, "facts_14_day_refresh": again}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "basketry-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            # no stack capture per column expression while plans are built
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["stg_order_items"](spark, folder))  # warm up the JVM
    names = sys.argv[1:] or HEADLINE
    times = {n: timed(lambda n=n: run(QUERIES[n](spark, folder))) for n in names}
    if not sys.argv[1:]:
        times |= refresh_ratio(spark, folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
