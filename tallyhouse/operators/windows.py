"""Ordered operators that stay distributed when one group is huge.

A plain window sends a group to one task. Here a group is cut into blocks, each
block is worked on by itself, and one short row per block carries the state on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.money import TOTAL
from tallyhouse.session import settle

BLOCK_BITS = 20     # rows of one fill block: 2**20 order numbers
RANGE_ROWS = 1 << 20    # distinct values of one range of a running total, about
BLOCK_RANGES = 1 << 10  # ranges whose totals are added up by one task


def ffill(
    df: DataFrame, key: list[str], order: str, cols: list[str], blank: str | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Carry the last value forward inside a key, in ``order`` (an integer column).

    ``blank`` is a pattern of text that counts as missing. Key columns hold no NULL.
    """
    if not cols:
        return df
    q = {c: F.col(f"`{c}`") for c in cols}
    masked = df
    if blank is not None:
        masked = df.select(
            *[F.col(f"`{c}`") if c not in q else F.when(~q[c].rlike(blank), q[c]).alias(c) for c in df.columns]
        )
    blocked = masked.withColumn("_block", F.shiftright(F.col(order), block_bits))
    quoted = [f"`{k}`" for k in key]

    inside = Window.partitionBy(*quoted, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    near = blocked.select(
        *[F.col(f"`{c}`") if c not in q else F.last(q[c], ignorenulls=True).over(inside).alias(c) for c in df.columns],
        "_block",
    )

    # the last row of a block knows all its last values
    ends = near.groupBy(*quoted, "_block").agg(F.max_by(F.struct(*[q[c] for c in cols]), order).alias("_end"))
    before = Window.partitionBy(*quoted).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *quoted,
        "_block",
        *[F.last(F.col("_end").getField(c), ignorenulls=True).over(before).alias(f"_in_{i}") for i, c in enumerate(cols)],
    )
    position = {c: i for i, c in enumerate(cols)}
    return near.join(carried, [*key, "_block"], "left").select(
        *[
            F.coalesce(q[c], F.col(f"_in_{position[c]}")).alias(c) if c in q else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def daily_fx(quotes: DataFrame, last_day: Column) -> DataFrame:
    """One rate per currency and day: each quote holds until the day before the next.

    ``quotes`` is ``(rate_date, currency, usd_rate)``; NULL rates are no quotes.
    """
    known = quotes.filter(F.col("usd_rate").isNotNull()).select(
        F.upper("currency").alias("currency"), "rate_date", "usd_rate"
    )
    by_currency = Window.partitionBy("currency").orderBy("rate_date")
    until = F.coalesce(F.date_sub(F.lead("rate_date").over(by_currency), 1), last_day)
    spans = known.withColumn("_until", until).filter(F.col("_until") >= F.col("rate_date"))
    days = F.explode(F.sequence("rate_date", "_until", F.expr("interval 1 day")))
    return spans.select(days.alias("rate_date"), "currency", "usd_rate")


def share_of(df: DataFrame, x: str, key: list[str], name: str) -> DataFrame:
    """``x`` over its sum within ``key`` (over everything for an empty key)."""
    if not key:
        total = df.agg(F.sum(x).cast(TOTAL)).scalar()
        return df.withColumn("_total", total).withColumn(name, _share(x)).drop("_total")
    totals = df.groupBy(*key).agg(F.sum(x).cast(TOTAL).alias("_total"))
    return df.join(totals, key, "left").withColumn(name, _share(x)).drop("_total")


def _share(x: str) -> Column:
    total = F.col("_total").cast("decimal(26,6)")
    part = F.col(x).cast("decimal(26,6)")
    return F.round(part / F.nullif(total, F.lit(0).cast("decimal(26,6)")), 12).cast("decimal(28,12)")


def levels(df: DataFrame, x: str, range_rows: int | None = None) -> DataFrame:
    """Distinct values of ``x`` with what lies at or above each of them.

    Columns: ``x``, ``rank`` (1 + rows above), ``cum`` (sum at or above). Ties share
    one row, so they always count together. Values are dealt into sampled ranges, as many
    as their number needs; each range is summed by its own task. The totals of the ranges
    are added up in blocks, the totals of the blocks by one task. Any cut gives the same
    result. The distinct values are read several times, so they are written first.
    """
    flat = settle(
        df.filter(F.col(x).isNotNull())
        .groupBy(x)
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(x).cast(TOTAL).alias("_s"))
    )
    ranges = max(1, -(-flat.count() // (range_rows or RANGE_ROWS)))
    ranged = settle(flat.repartitionByRange(ranges, F.desc(x)).withColumn("_range", F.spark_partition_id()))

    down = Window.partitionBy("_range").orderBy(F.desc(x))
    inside = ranged.select(
        x, "_range",
        F.sum("_s").over(down.rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"),
        F.sum("_n").over(down.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.col("_n"),
    )
    block = F.floor(F.col("_range") / BLOCK_RANGES).alias("_block")
    per_range = ranged.groupBy("_range").agg(F.sum("_s").alias("_rs"), F.sum("_n").alias("_rn")).select("*", block)
    per_block = per_range.groupBy("_block").agg(F.sum("_rs").alias("_bs"), F.sum("_rn").alias("_bn"))
    blocks_above = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)      # a row a block
    above = Window.partitionBy("_block").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)

    def before(c: str, w) -> Column:
        return F.coalesce(F.sum(c).over(w), F.lit(0))

    per_block = per_block.select("_block", before("_bs", blocks_above).alias("_bs"), before("_bn", blocks_above).alias("_bn"))
    offsets = per_range.select("_block", "_range", before("_rs", above).alias("_rs"), before("_rn", above).alias("_rn")).join(per_block, "_block")
    offsets = offsets.select("_range", (F.col("_rs") + F.col("_bs")).alias("_os"), (F.col("_rn") + F.col("_bn")).alias("_on"))
    # A row a range goes to the values, however large Spark takes it to be: never the values.
    return inside.join(F.broadcast(offsets), "_range").select(
        x,
        (F.col("_upto") - F.col("_n") + F.col("_on") + 1).cast("bigint").alias("rank"),
        (F.col("_cum") + F.col("_os")).cast(TOTAL).alias("cum"),
    )


def running_total(df: DataFrame, x: str, cum: str, share: str | None = None) -> DataFrame:
    """Sum of ``x`` over all rows with at least this row's ``x``; NULL stays NULL."""
    df = settle(df)
    table = levels(df, x).select(x, F.col("cum").alias(cum))
    out = df.join(table, x, "left")
    if share is None:
        return out
    total = df.agg(F.sum(x).cast(TOTAL)).scalar()
    part = F.col(cum).cast("decimal(26,6)") / F.nullif(total.cast("decimal(26,6)"), F.lit(0).cast("decimal(26,6)"))
    return out.withColumn(share, F.round(part, 12).cast("decimal(28,12)"))
