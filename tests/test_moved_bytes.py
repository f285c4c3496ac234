"""Lines are moved once, key texts lie in no file, and shuffles grow in number, not in size."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans.measures import MEASURES, reduced
from tallyhouse.queries.adapter import ID_BUCKETS, line_text, with_line_id
from tallyhouse.session import SPLIT_BYTES, TASK_BYTES, size_shuffles

LINE = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_of_crowded_buckets_only_are_moved(run):
    shown = plan(with_line_id(run.table("lineitem")))
    below = shown.split("Exchange hashpartitioning")
    assert "LeftAnti" in below[0] and "LeftSemi" in below[1]


def test_line_ids_count_within_buckets(rows):
    part = [(k, p, 1, 1, 1.0, 2.0, 0.0, 0.0, "R", "F", None) for k in (1, None) for p in range(150)]
    lines = rows(part + part[::3] + part[::3] + [(2, None, None, None, None, None, None, None, None, None, None)], LINE)
    bucket = F.conv(F.substring(F.md5(line_text()), 1, 3), 16, 10).cast("int") % ID_BUCKETS
    wanted = Counter()
    for (order, place), n in Counter((r.l_orderkey, r.b) for r in lines.select("l_orderkey", bucket.alias("b")).collect()).items():
        wanted.update((order, i * ID_BUCKETS + place) for i in range(1, n + 1))
    numbered = with_line_id(lines)
    assert numbered.columns == [*lines.columns, "line_id"] and dict(numbered.dtypes)["line_id"] == "bigint"
    assert Counter((r.l_orderkey, r.line_id) for r in numbered.collect()) == wanted and set(wanted.values()) == {1}


@pytest.mark.parametrize("table, gone", [
    ("fact_order_item", {"order_item_sk", "order_sk", "site_sk", "product_sk"}),
    ("fact_order", {"order_sk", "site_sk", "order_natural_key"}),
    ("stg_orders", {"customer_hash", "order_natural_key"}),
])
def test_files_hold_no_text_that_follows_from_others(star, spark, table, gone):
    read = getattr(star, table)
    files = spark.read.parquet(f"{star.path}/{table}")
    assert set(read.columns) - set(files.columns) == gone
    digests = {"customer_sk", "country_sk", "payment_method_sk", "billing_email_hash"} & set(files.columns)
    assert digests and {dict(files.dtypes)[c] for c in digests} == {"binary"} and {dict(read.dtypes)[c] for c in digests} == {"string"}


def test_lines_are_not_moved_again_behind_their_join(star, spark, monkeypatch):
    from tallyhouse.plans import warehouse

    monkeypatch.setattr(warehouse, "_dealt", lambda df: pytest.fail("dealt"))
    path = f"{star.path}/again"
    again = warehouse.Star(star.inputs, spark, path)
    again.written |= {t: getattr(star, t) for t in ("stg_orders", "stg_order_items", "fact_order")}
    assert again.fact_order_item.count() == star.stg_order_items.count()
    name = F.input_file_name()
    for file in spark.read.parquet(f"{path}/fact_order_item").groupBy(name).agg(F.collect_list(F.coalesce("date_sk", F.lit(0))).alias("d")).collect():
        assert file.d == sorted(file.d)


def test_partitions_follow_the_input(spark):
    key, advised = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    held = [spark.conf.getAll.get(k) for k in (key, advised)]
    try:
        spark.conf.unset(advised)
        assert size_shuffles(spark, 1000) == int(spark.conf.get("spark.sql.shuffle.partitions")) == int(spark.conf.get(key))
        assert spark.conf.get(advised) == str(TASK_BYTES)
        spark.conf.set(advised, "8m")
        assert size_shuffles(spark, 6 << 30) == 1536 == int(spark.conf.get(key)) and spark.conf.get(advised) == "8m"
    finally:
        for k, v in zip((key, advised), held, strict=True):
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_tasks_read_small_parts_of_files(spark):
    key = "spark.sql.files.maxPartitionBytes"
    held = spark.conf.getAll.get(key)
    try:
        spark.conf.unset(key)
        size_shuffles(spark, 1000)
        assert spark.conf.get(key) == str(SPLIT_BYTES)
        spark.conf.set(key, "8m")
        size_shuffles(spark, 1000)
        assert spark.conf.get(key) == "8m"
    finally:
        spark.conf.set(key, held) if held else spark.conf.unset(key)


def test_products_are_moved_by_their_ids(star):
    small, _ = reduced(star, "fact_order_item", {"revenue": MEASURES["revenue"].parts["revenue"]}, ["product_sk"])
    assert small.columns == ["product_sk", "revenue"]
    moved = [line for line in plan(small).splitlines() if "Exchange hashpartitioning" in line]
    assert moved and all("product_sk" not in line and "woo_product_id" in line for line in moved)
    summed = {r.product_sk: r.revenue for r in small.collect()}
    direct = star.fact_order_item.groupBy("product_sk").agg(F.sum(F.when(F.col("is_revenue_status"), F.col("line_revenue_usd"))).alias("revenue"))
    assert summed == {r.product_sk: r.revenue for r in direct.collect()}


def test_orders_are_dealt_with_their_customers_key(star, spark, monkeypatch):
    from tallyhouse.plans import warehouse

    seen = []
    dealt = warehouse._dealt
    monkeypatch.setattr(warehouse, "_dealt", lambda df, day: seen.append(df.columns) or dealt(df, day))
    again = warehouse.Star(star.inputs, spark, f"{star.path}/keyed")
    again.written |= {"stg_orders": star.stg_orders}
    found = again.fact_order
    assert "customer_sk" in seen[0] and found.columns == star.fact_order.columns
    assert found.exceptAll(star.fact_order).isEmpty() and star.fact_order.exceptAll(found).isEmpty()
