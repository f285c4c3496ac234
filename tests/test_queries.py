"""Registered queries against their SQL in DuckDB on the smallest tables.

One of each kind; ``check.py`` runs all of them.
"""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from check import rows_of  # noqa: E402
from tallyhouse.queries import oracle_sql, queries  # noqa: E402
from tests.conftest import SMALL  # noqa: E402

NAMES = [
    "s2_land_order_items", "s7_build_cost_rows", "s9_upsert_latest", "s11_replace_children", "p1_stg_orders", "p2_stg_order_items",
    "m5_dim_product", "m6_dim_customer_anonymized", "m7_fact_order", "m8_fact_order_item", "m9_fact_refund", "m10_fact_order_cost",
    "m11_mart_order_profit", "m12_mart_product_profit", "m13_mart_customer_summary", "m14_recon_cost_coverage", "m18_recon_shipping_charged",
    "w1_forward_fill", "w5_running_share", "t1k_top_percent", "q1_sales_by_month", "q5_profit_by_country", "q26_overview", "d1_mom", "d2_yoy_refunded_orders",
    "d3_pop", "x3_unique_combination",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    df = queries()[name](spark, SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(oracle_sql()[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())
