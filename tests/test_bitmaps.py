"""Bitmaps of few among many keys."""

from pyspark.sql import functions as F

from tallyhouse.plans import distinct


def test_a_key_does_not_cost_a_whole_bitmap(spark):
    """A day has 100 of 100,000 keys, in four buckets: 4 KB for each of them would be 16 MB."""
    numbers = spark.range(1, 100_001).select(F.col("id").alias("key"), F.col("id").alias("number"))
    rows = numbers.select("key", (F.col("key") % 1000).cast("int").alias("date_sk"))
    maps = distinct.bitmaps(rows, "key", numbers, ["date_sk"])
    assert maps.toArrow().nbytes < 4 << 20
    assert {r.n for r in distinct.counted(maps, ["date_sk"], "n").collect()} == {100}
    assert distinct.between(maps, 10, 19, "n").first().n == 1000


def test_words_at_their_edges(spark):
    keys = [1, 2, 63, 64, 65, 128, 129, 32767, 32768, 32769, 65536, 65537]
    numbers = spark.createDataFrame([(k, k) for k in keys], "key long, number long")
    rows = numbers.select("key", F.lit(1).alias("date_sk")).unionByName(numbers.filter("key > 64").select("key", F.lit(2).alias("date_sk")))
    maps = distinct.bitmaps(rows, "key", numbers, ["date_sk"])
    assert {r.date_sk: r.n for r in distinct.counted(maps, ["date_sk"], "n").collect()} == {1: 12, 2: 8}
    assert distinct.between(maps, 1, 2, "n").first().n == 12


def test_numbers_follow_the_order_of_keys(spark):
    found = distinct.number_keys(spark.range(5000).select((F.col("id") * 7 % 1500).alias("k")), "k").orderBy("number").collect()
    assert [(r.k, r.number) for r in found] == [(i, i + 1) for i in range(1500)]
