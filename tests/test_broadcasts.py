"""What must not be sent to the driver, however small Spark takes it to be."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from tallyhouse.operators.checks import check_relationship
from tallyhouse.operators.windows import levels
from tallyhouse.plans.dims import dim_product
from tallyhouse.plans.measures import slice_by
from tallyhouse.plans.staging import stg_products
from tallyhouse.queries import adapter
from tallyhouse.session import settle


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_listed_catalogue_is_not_broadcast(spark, tmp_path):
    """Parts listed by site, in an explode, have many times the bytes of their files."""
    spark.range(40).selectExpr("id as p_partkey", "'bolt' as p_name").write.parquet(f"{tmp_path}/part.parquet")
    listed = stg_products(adapter.product_documents(lambda name: spark.read.parquet(f"{tmp_path}/{name}.parquet")))
    sold = [("S1", 7, "bolt", "SKU-7"), ("S1", 50, "gone", "SKU-50"), ("S9", 7, "other", "SKU-7")]
    items = spark.createDataFrame(sold, "site_code string, woo_product_id long, product_name_at_sale string, sku string")
    dim = dim_product(listed, items)
    lost = check_relationship(items, "woo_product_id", listed, "woo_product_id")
    for df in (dim, lost):
        assert "BroadcastExchange" not in plan_of(df)
    assert dim.count() == 39 * 5 + 2
    added = {(r.site_code, r.woo_product_id, r.product_name) for r in dim.filter("product_type = 'unknown'").collect()}
    assert added == {("S1", 50, "gone"), ("S9", 7, "other")} and [r.fk for r in lost.collect()] == [50]


def test_levels_send_a_row_a_range(spark):
    """The values of a running total stay where they are; the totals of their ranges move."""
    df = spark.range(400).select((F.col("id") % 90).cast("decimal(18,6)").alias("x"))
    found = levels(df, "x", 20)
    rows = found.collect()
    met = [line for line in plan_of(found).splitlines() if "HashJoin [_range" in line]      # as run, then as planned
    assert met and all("BuildRight" in line for line in met)
    values = sorted((int(r.x) for r in df.collect()), reverse=True)
    want = {v: (1 + sum(u > v for u in values), sum(u for u in values if u >= v)) for v in set(values)}
    assert {int(r.x): (r["rank"], int(r.cum)) for r in rows} == want


def test_products_are_not_broadcast(spark):
    """Their written files are far smaller than their rows."""
    names = [(f"k{i}", f"name {i % 5}") for i in range(60)]
    star = SimpleNamespace(dim_product=settle(spark.createDataFrame(names, "product_sk string, product_name string")))
    sold = spark.createDataFrame([(f"k{i}", i) for i in range(0, 80, 2)], "product_sk string, n int")
    named = slice_by(star, sold, ["product_name"])
    assert "BroadcastExchange" not in plan_of(named)
    assert {(r.product_sk, r.product_name) for r in named.collect()} == {(f"k{i}", f"name {i % 5}" if i < 60 else None) for i in range(0, 80, 2)}
