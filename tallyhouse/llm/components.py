"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import settle


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Links of every node ``u`` (its larger ones, or its smaller ones and itself) to the
    least node among its neighbours and itself. Least nodes come from an aggregate, which
    combines before its shuffle; a node with very many links is split by the join."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = both.join(least, "u")
    if large:
        out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node reachable) of every node that has a link.

    ``links`` has ``u``, ``v``. Rounds go on until the links no longer change; each is
    written to the shared folder, which cuts the lineage."""
    pairs = settle(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct())

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    seen = mark(pairs)
    while True:
        pairs = settle(_star(_star(pairs, large=True), large=False))
        now = mark(pairs)
        if now == seen:
            break
        seen = now
    roots = pairs.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
