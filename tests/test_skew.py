"""The same queries on tables where one order holds a third of the lines, one
customer a third of the orders, and one line has thousands of exact copies."""

import glob
import os
import shutil

import pytest

duckdb = pytest.importorskip("duckdb")

from check import rows_of  # noqa: E402
from tallyhouse.queries import oracle_sql, queries  # noqa: E402
from tests.conftest import SMALL  # noqa: E402

NAMES = [
    "p2_stg_order_items", "m8_fact_order_item", "m11_mart_order_profit", "m12_mart_product_profit", "m13_mart_customer_summary",
    "w3_share_of_order", "w5_running_share", "x11_conservation", "q8_product_profit", "s11_replace_children",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for path in glob.glob(f"{SMALL}/*.parquet"):
        if os.path.basename(path) not in ("orders.parquet", "lineitem.parquet"):
            shutil.copyfile(path, f"{folder}/{os.path.basename(path)}")
    con = duckdb.connect()
    con.execute(f"""copy (select case when n % 3 = 0 then 21 else l_orderkey end as l_orderkey, * exclude (l_orderkey, n)
        from (select *, row_number() over () as n from '{SMALL}/lineitem.parquet')
        union all select x.* from (select * from '{SMALL}/lineitem.parquet' limit 1) x, range(3000)) to '{folder}/lineitem.parquet' (format parquet)""")
    con.execute(f"""copy (select o_orderkey, case when o_orderkey % 3 = 0 then 5 else o_custkey end as o_custkey, * exclude (o_orderkey, o_custkey)
        from '{SMALL}/orders.parquet') to '{folder}/orders.parquet' (format parquet)""")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return folder, con


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql_under_skew(spark, skewed, name):
    folder, con = skewed
    df = queries()[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(oracle_sql()[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())
