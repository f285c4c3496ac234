"""Rankings: top percent, percent to reach a share, best name, top n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.money import TOTAL
from tallyhouse.operators.windows import levels
from tallyhouse.session import settle

PERCENTS = 100


def top_percent(df: DataFrame, x: str) -> DataFrame:
    """Share of the total held by the top p percent of rows, p = 1..100.

    The top K = ceil(n p / 100) rows include all ties of the K-th. Every value
    level is placed once at the smallest percent that takes it in, so no row meets
    all hundred percents.
    """
    df = settle(df.select(x))
    ranked = levels(df, x)
    n = df.agg(F.count(x)).scalar()
    total = df.agg(F.sum(x).cast(TOTAL)).scalar()
    entered = ranked.withColumn("_n", n).select(
        F.expr("100 * (rank - 1) div _n + 1").cast("int").alias("percent"), "cum"
    )
    steps = entered.groupBy("percent").agg(F.max("cum").alias("_cum"))       # <= 100 rows
    upto = Window.orderBy("percent").rowsBetween(Window.unboundedPreceding, 0)
    scale = df.sparkSession.range(1, PERCENTS + 1).select(F.col("id").cast("int").alias("percent"))
    share = F.max("_cum").over(upto).cast("decimal(26,6)") / F.col("_total").cast("decimal(26,6)")
    return scale.join(steps, "percent", "left").withColumn("_total", total).select(
        "percent", F.round(share, 12).cast("decimal(28,12)").alias("cum_share")
    )


def percent_to_reach(df: DataFrame, x: str, targets: dict[str, float]) -> DataFrame:
    """One row: the smallest percent of rows that holds each target share."""
    curve = top_percent(df, x)
    return curve.agg(
        *[
            F.min(F.when(F.col("cum_share") >= F.lit(str(t)).cast("decimal(28,12)"), F.col("percent"))).alias(name)
            for name, t in targets.items()
        ]
    )


def top_name(df: DataFrame, name: str, x: str, alias: str, floor: Column | None = None) -> DataFrame:
    """One row: the name with the highest ``x``; the last name wins a tie."""
    pool = df if floor is None else df.filter(floor)
    return pool.agg(F.max_by(name, F.struct(F.col(x), F.col(name))).alias(alias))


def top_n(df: DataFrame, x: str, n: int) -> DataFrame:
    """The rows with the ``n`` highest values, ties of the last one included; rows without
    a value come last, and count where fewer than ``n`` have one."""
    head = df.select(x).orderBy(F.desc_nulls_last(x)).limit(n)
    cut = head.agg(F.struct(F.min(x).alias("low"), F.count(x).alias("n"))).scalar()
    taken = F.coalesce(F.col(x) >= F.col("_cut.low"), F.lit(False)) | (F.col(x).isNull() & (F.col("_cut.n") < n))
    return df.withColumn("_cut", cut).filter(taken).drop("_cut")


def order_by_ordinal(df: DataFrame, ordinal: str) -> DataFrame:
    """Sort a label column by its number (month, weekday, step)."""
    return df.orderBy(ordinal)
