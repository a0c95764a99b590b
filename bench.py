"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every query
runs twice and the second, warm run counts; results are written to the no-op
sink, so all rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from mercatura.session import build_session
from oracles.registry import REGISTRY

HEADLINE = [
    "stg_orders",
    "stg_order_items",
    "stg_payments",
    "stg_reviews",
    "int_orders_enriched",
    "int_order_items_enriched",
    "int_customer_enriched",
    "int_delivery_analysis",
    "mart_category_performance",
    "mart_customer_cohorts",
    "mart_delivery_analysis",
    "mart_payment_behavior",
    "mart_rfm_segmentation",
    "mart_seller_performance",
    "anl_seller_matrix",
    "anl_worst_corridors",
    "anl_cohort_retention",
    "anl_clv_by_cohort",
    "anl_order_funnel",
    "fact_order_items",
    "scd2_customers",
    "scd2_as_of_items",
    "ing_load_summary",
    "ing_contract_orders",
    "upsert_orders",
    "upsert_order_partitions",
    "stream_upsert_orders",
    "dq_orders_suite",
    "dq_staging_tests",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = build_session(
        "bench",
        spark_master=f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_ui_enabled="false",
        spark_driver_memory="8g",
        spark_checkpoint_dir=tempfile.mkdtemp(prefix="mercatura-bench-", dir="/tmp"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
