"""Headline queries, timed one by one. Prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the cores. Each query is run to its end
(all columns of all rows) into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import time

from tallyhouse.queries import queries
from tallyhouse.queries.registry import run_for
from tallyhouse.session import local_session

# One of each kind of work; the first one in the list that needs the star pays for
# publishing it, so that is timed as a step of its own.
HEADLINE = [
    "p1_stg_orders", "p2_stg_order_items", "m7_fact_order", "m8_fact_order_item", "m11_mart_order_profit",
    "m12_mart_product_profit", "m13_mart_customer_summary", "m5_dim_product", "m14_recon_cost_coverage",
    "m18_recon_shipping_charged", "s7_build_cost_rows", "s9_upsert_latest", "w1_forward_fill", "w5_running_share",
    "q1_sales_by_month", "q5_profit_by_country", "q8_product_profit", "q18_pareto", "q26_overview", "d1_mom", "d7_ytd",
    "x11_conservation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores)
    every = queries()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()     # start the JVM up

    times: dict[str, float] = {}
    start = time.time()
    run_for(spark, sf_dir).star.write_all()
    times["publish_star"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf_dir}))


if __name__ == "__main__":
    main()
