"""The customer summary kept up batch by batch.

A customer's *state* is what the summary is made of and what merges: sums of orders,
revenue and profit, first and last day, and how many orders each site and country has (for
the most frequent ones). A batch of orders is reduced to states of its customers; these are
merged with the states held, which lie in buckets of customers. Only buckets with a touched
customer are read and written again; a small log says which batch wrote a bucket last.

An order pulled again is taken back and put in again: rows have a ``weight`` of 1 or -1.
Sums and counts follow; its day must stay the same, for first and last days only widen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.money import TOTAL
from tallyhouse.plans.marts import summary_columns
from tallyhouse.sources.loads import BATCH, append_batch

#: Buckets of customers; a folder each in every batch that touches it.
BUCKETS = 256
VALUE = "order_revenue_usd"
KEY = "customer_hash"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int").alias("bucket")


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Orders pulled again: their rows as they were counted, and as they are now."""
    return before.withColumn("weight", F.lit(-1)).unionByName(after.withColumn("weight", F.lit(1)))


def _entries(key: str) -> Column:
    """Counts by value; orders without a value count for none."""
    return F.collect_list(F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("value"), F.col("_n").alias("n"))))


def states(orders: DataFrame) -> DataFrame:
    """One state per customer of ``customer_orders`` rows, weighted where they say so."""
    weight = F.col("weight") if "weight" in orders.columns else F.lit(1)
    # By customer, site and country first: a customer of very many orders is combined early.
    fine = orders.groupBy(KEY, "site_code", "country_code").agg(
        F.sum(weight).alias("_n"),
        F.sum(F.col(VALUE) * weight).cast(TOTAL).alias("revenue"),
        F.sum(F.col("order_profit_usd") * weight).cast(TOTAL).alias("profit"),
        F.sum(F.when(F.col("order_profit_usd").isNotNull(), weight)).alias("profits"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return fine.groupBy(KEY).agg(
        F.sum("_n").alias("orders"), *[F.sum(c).cast(TOTAL).alias(c) for c in ("revenue", "profit")], F.sum("profits").alias("profits"),
        F.min("first_order_date").alias("first_order_date"), F.max("last_order_date").alias("last_order_date"),
        _entries("site_code").alias("sites"), _entries("country_code").alias("countries"),
    )


def merged(several: DataFrame) -> DataFrame:
    """States of a customer from several batches as one."""
    return several.groupBy(KEY).agg(
        F.sum("orders").alias("orders"), *[F.sum(c).cast(TOTAL).alias(c) for c in ("revenue", "profit")], F.sum("profits").alias("profits"),
        F.min("first_order_date").alias("first_order_date"), F.max("last_order_date").alias("last_order_date"),
        *[_added(F.flatten(F.collect_list(c))).alias(c) for c in ("sites", "countries")],
    )


def _added(entries: Column) -> Column:
    """One entry a value, with the sum of its counts; none where nothing is left. There are
    as many entries as sites or countries, a few times over."""
    values = F.array_distinct(F.transform(entries, lambda e: e["value"]))

    def total(value: Column) -> Column:
        mine = F.filter(entries, lambda e: e["value"] == value)
        return F.aggregate(mine, F.lit(0).cast("bigint"), lambda acc, e: acc + e["n"])

    return F.filter(F.transform(values, lambda v: F.struct(v.alias("value"), total(v).alias("n"))), lambda e: e["n"] != 0)


def _most_frequent(entries: Column) -> Column:
    """The value with the highest count, the smallest of several."""
    ranked = F.array_sort(F.transform(entries, lambda e: F.struct((-e["n"]).alias("n"), e["value"].alias("value"))))
    return F.get(ranked, F.lit(0))["value"]


def _paths(spark: SparkSession, path: str, before: int | None = None) -> dict[int, str]:
    """The folder each bucket was last written to, by batches up to ``before``."""
    log = f"{path}/written"
    target = spark._jvm.org.apache.hadoop.fs.Path(log)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return {}
    rows = spark.read.schema(f"bucket int, {BATCH} bigint").option("basePath", log).parquet(log)
    if before is not None:
        rows = rows.filter(F.col(BATCH) < before)
    last = rows.groupBy("bucket").agg(F.max(BATCH).alias(BATCH)).collect()       # a row a bucket
    return {r["bucket"]: f"{path}/states/{BATCH}={r[BATCH]}/bucket={r['bucket']}" for r in last}


def update(orders: DataFrame, path: str, batch_id: int, buckets: int = BUCKETS) -> list[int]:
    """Merge a batch of orders into the states under ``path``; the buckets it touched.

    Batches come in order; the last one may be repeated, from the states before it."""
    spark = orders.sparkSession
    fresh = states(orders).select("*", _bucket(buckets)).persist()
    try:
        touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())       # bounded by ``buckets``
        held = _paths(spark, path, batch_id)
        old = [held[b] for b in touched if b in held]
        rows = fresh.drop("bucket")
        if old:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(*old))
        out = merged(rows).select("*", _bucket(buckets)).repartition("bucket")        # a file a bucket
        out.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/states/{BATCH}={batch_id}")
        append_batch(fresh.select("bucket").distinct(), f"{path}/written", batch_id)
    finally:
        fresh.unpersist()
    return touched


def summary(spark: SparkSession, path: str) -> DataFrame:
    """The customer summary as of the last batch; customers without any order left are out."""
    held = spark.read.parquet(*_paths(spark, path).values())
    people = held.filter(F.col("orders") > 0).select(
        KEY,
        F.col("orders").alias("total_orders"),
        F.col("revenue").alias("total_revenue_usd"),
        F.when(F.col("profits") > 0, F.col("profit")).alias("total_profit_usd"),
        "first_order_date",
        "last_order_date",
        _most_frequent(F.col("sites")).alias("_site"),
        _most_frequent(F.col("countries")).alias("_country"),
    )
    return summary_columns(people)
