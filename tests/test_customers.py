"""Customer states merged batch by batch."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.plans import customers

SCHEMA = "site_code string, woo_order_id long, customer_hash string, order_date date, country_code string, order_revenue_usd decimal(28,6), order_profit_usd decimal(28,6)"


def order(k, who, site="A", country="DE", day=1, revenue=10, profit=1):
    return (site, k, who, date(2020, 1, day), country, Decimal(revenue), None if profit is None else Decimal(profit))


def test_states_merge(spark, rows, tmp_path):
    path = str(tmp_path)
    one = rows([order(1, "x", "B"), order(2, "x", "A", None, 5, 20, None), order(3, "y", revenue=7, profit=None)], SCHEMA)
    customers.update(one, path, 0)
    customers.update(rows([order(4, "x", "A", "FR", 9), order(5, "z", "C")], SCHEMA), path, 1)
    got = {r.customer_hash: r for r in customers.summary(spark, path).collect()}
    x = got["x"]
    assert (x.total_orders, float(x.total_revenue_usd), float(x.total_profit_usd), x.first_order_date, x.last_order_date) == (3, 40.0, 2.0, date(2020, 1, 1), date(2020, 1, 9))
    assert x.preferred_site_sk == spark.range(1).select(F.md5(F.lit("A"))).first()[0]              # twice
    assert x.preferred_country_sk == spark.range(1).select(F.md5(F.lit("DE"))).first()[0]          # the smaller of two
    assert got["y"].total_profit_usd is None and got["z"].total_orders == 1 and not got["z"].is_repeat


def test_order_taken_back_and_put_in_again(spark, rows, tmp_path):
    path = str(tmp_path)
    was, now = rows([order(1, "x", revenue=10)], SCHEMA), rows([order(1, "x", "B", "FR", revenue=4)], SCHEMA)
    customers.update(was.unionByName(rows([order(2, "y")], SCHEMA)), path, 0)
    for _ in range(2):                                               # a repeated batch
        customers.update(customers.changes(was, now), path, 1)
    got = {r.customer_hash: r for r in customers.summary(spark, path).collect()}
    assert (got["x"].total_orders, float(got["x"].total_revenue_usd)) == (1, 4.0)
    assert got["x"].preferred_site_sk == spark.range(1).select(F.md5(F.lit("B"))).first()[0]
    customers.update(rows([order(2, "y")], SCHEMA).withColumn("weight", F.lit(-1)), path, 2)
    assert {r.customer_hash for r in customers.summary(spark, path).collect()} == {"x"}


def test_untouched_buckets_are_not_read(spark, rows, tmp_path):
    path = str(tmp_path / "state")
    customers.update(rows([order(i, f"c{i}") for i in range(300)], SCHEMA), path, 0, buckets=16)
    late = rows([order(900, "c7", revenue=1)], SCHEMA)
    bucket = late.select(F.pmod(F.xxhash64("customer_hash"), F.lit(16)).alias("b")).first().b
    kept = {}
    for file in (tmp_path / "state" / "states").rglob("*.parquet"):
        if f"bucket={bucket}/" not in str(file):
            kept[file] = file.read_bytes()
            file.write_bytes(b"no parquet")
    for crc in (tmp_path / "state" / "states").rglob(".*.crc"):
        if f"bucket={bucket}/" not in str(crc):
            crc.write_bytes(b"")
    assert len(kept) == 15 and customers.update(late, path, 1, buckets=16) == [bucket]
    assert len(list((tmp_path / "state" / "states" / "batch_id=1").glob("bucket=*"))) == 1
