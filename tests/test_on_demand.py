"""A star writes what a query reads, and nothing else; its facts move without their key texts."""

import os

from pyspark.sql import functions as F

from tallyhouse.plans.warehouse import Star, Warehouse, _dealt, publish
from tallyhouse.queries import adapter
from tallyhouse.queries.adapter import with_line_id


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written(path):
    return {n for n in os.listdir(path) if n != "days"} if os.path.exists(path) else set()


def test_only_what_is_read_is_written(run, spark, tmp_path):
    star = Star(run.wh.inputs, spark, str(tmp_path / "s"))
    assert written(star.path) == set()
    orders = star.stg_orders
    assert written(star.path) == {"stg_orders"} and star.stg_orders is orders
    assert star.fact_refund.count() > 0
    assert written(star.path) == {"stg_orders", "fact_order", "fact_refund"}
    assert "fact_refund" in star.days and not os.path.exists(f"{star.path}/days")
    assert star.days["fact_refund"].count() > 0
    assert set(os.listdir(f"{star.path}/days")) == {"fact_refund"}
    whole = star.write_all()
    assert whole.stg_orders is orders and {"mart_customer_summary", "dim_product"} <= written(star.path)


def test_moved_rows_are_the_rows(star):
    for name in ("fact_order", "fact_order_item", "fact_refund", "fact_order_cost", "mart_order_profit", "mart_product_profit"):
        plain, dealt = getattr(Warehouse, name).func(star), getattr(star, name)
        assert plain.columns == dealt.columns
        assert [f.dataType for f in plain.schema] == [f.dataType for f in dealt.schema]
        assert plain.exceptAll(dealt).count() == 0 and dealt.exceptAll(plain).count() == 0


def test_nulls_in_keys_pass_the_shuffle(rows):
    df = rows(
        [("S1", 1, None, "0f" * 16, 20240101), (None, None, "ab" * 16, None, None)],
        "site_code string, woo_order_id bigint, customer_sk string, country_sk string, date_sk int",
    )
    assert sorted(map(str, _dealt(df).collect())) == sorted(map(str, df.collect()))


def test_key_texts_are_made_behind_the_shuffle(star):
    shown = plan(_dealt(star.fact_order_item))
    assert "md5" in shown.split("rangepartitioning")[0] and "order_item_sk" not in shown.split("rangepartitioning")[1].split("Location")[0]


def test_line_text_is_not_shuffled(run):
    shown = plan(with_line_id(run.table("lineitem")))
    assert shown.count("Exchange hashpartitioning") == 1
    below = shown.split("Exchange hashpartitioning")[1]
    assert "_text" not in below
