"""Distinct keys as exact bitmaps that merge over days, batches and levels.

Counts of distinct keys don't add up. Here every key has a dense number, and the keys of a
day are bits: one bitmap for each day and each 32,768 numbers. Bitmaps of days, of batches
or of months are united bit by bit, so one daily pass over a fact answers for any span and
every level of the calendar, exactly.

A bitmap is held as its words of 64 bits, a row each; empty ones have no row. A day has few
of many keys: whole bitmaps would be 4 KB of zeros for each key that is moved or sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.plans.measures import PARTS, fact_table
from tallyhouse.session import settle
from tallyhouse.sources.loads import BATCH, append_batch

BITMAP = ("bucket", "word", "bits")


def number_keys(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """``key`` and ``number``: dense, from 1, or on from the numbers already ``known``.

    Keys are dealt by range and numbered in order by many tasks, as they are written; one row
    a range carries the count on. Known keys keep their numbers, NULL has none.
    """
    rows = keys.filter(F.col(key).isNotNull()).select(key).distinct()
    first = 1
    if known is not None:
        rows = rows.join(known.select(key), key, "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(1))).first()[0]
    # The id has the range in its upper 31 bits, the place there in the lower 33.
    dealt = settle(rows.repartitionByRange(key).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)       # a row a range
    counts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_at").bitwiseAND((1 << 33) - 1)
    new = dealt.join(counts, "_range").select(key, (F.lit(first) + F.col("_before") + place).cast("bigint").alias("number"))
    return new if known is None else known.select(key, "number").unionByName(new)


def bitmaps(rows: DataFrame, key: str, numbers: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``bucket``, ``word`` and ``bits`` of the keys each group has. Keys are made distinct
    per group before they are looked up, so a hot key is one row per task."""
    held = rows.filter(F.col(key).isNotNull()).select(*by, key).distinct().join(numbers, key)
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    word = F.shiftright(F.bitmap_bit_position("number"), 6).cast("smallint").alias("word")
    bit = F.expr("shiftleft(1L, cast(bitmap_bit_position(number) & 63 as int))")
    return held.groupBy(*by, bucket, word).agg(F.bit_or(bit).alias("bits"))


def united(maps: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return maps.groupBy(*by, *BITMAP[:2]).agg(F.bit_or("bits").alias("bits"))


def counted(maps: DataFrame, by: list[str], name: str) -> DataFrame:
    """How many distinct keys each group has; bitmaps must be united by ``by`` already."""
    return maps.groupBy(*by).agg(F.sum(F.bit_count("bits")).cast("bigint").alias(name))


def part_rows(star, part: str) -> DataFrame:
    """The rows of a fact a distinct part counts keys of."""
    p = PARTS[part]
    if p.kind != "distinct":
        raise ValueError(f"{part} is no distinct count")
    df = fact_table(star, p.fact)
    return df if p.where is None else df.filter(p.where())


def append(rows: DataFrame, key: str, numbers: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch of fact rows to the daily bitmaps; the same batch again changes nothing."""
    append_batch(bitmaps(rows, key, numbers, ["date_sk"]), path, batch_id)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Daily bitmaps over all batches."""
    maps = spark.read.option("basePath", path).parquet(path).drop(BATCH)
    return united(maps, ["date_sk"])


def daily(star, part: str) -> DataFrame:
    """Daily bitmaps of a distinct part, from one pass over its fact."""
    key, rows = PARTS[part].column, part_rows(star, part)
    return bitmaps(rows, key, number_keys(rows, key), ["date_sk"])


def drill(star, part: str, levels: list[str]) -> DataFrame:
    """The distinct count at every level of ``levels`` (outer first, of the calendar) and in
    total, with ``level``: bitmaps of the finest level are united from level to level."""
    maps = settle(united(daily(star, part).join(star.dim_date.select("date_sk", *levels), "date_sk"), levels))
    out = None
    for depth in range(len(levels), -1, -1):
        by = levels[:depth]
        maps = united(maps, by)
        rest = [F.lit(None).cast(star.dim_date.schema[c].dataType).alias(c) for c in levels[depth:]]
        found = counted(maps, by, part).select(*by, *rest, F.lit(depth).alias("level"), F.nullif(part, F.lit(0)).alias(part))
        out = found if out is None else out.unionByName(found)
    return out.filter((F.col("level") > 0) | F.col(part).isNotNull())


def between(maps: DataFrame, first: int, last: int, name: str) -> DataFrame:
    """The distinct keys of a range of days, from daily bitmaps."""
    return counted(united(maps.filter(F.col("date_sk").between(first, last)), []), [], name)
