"""Aggregates the marts and reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import TOTAL, percent
from tallyhouse.operators.windows import levels
from tallyhouse.session import settle


def sum_where(x: Column | str, condition: Column) -> Column:
    value = F.col(x) if isinstance(x, str) else x
    return F.sum(F.when(condition, value)).cast(TOTAL)


def distinct_where(key: Column | str, condition: Column) -> Column:
    value = F.col(key) if isinstance(key, str) else key
    return F.count_distinct(F.when(condition, value))


def first_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row with the lowest ``order`` per key, as a combining aggregate."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)


def nulls_last(c: str) -> list[Column]:
    """Order columns that put NULL behind every value."""
    return [F.col(c).isNull(), F.col(c)]


def per_order(df: DataFrame, x: str, name: str, keys: tuple[str, ...] = ("site_code", "woo_order_id")) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(x).cast(TOTAL).alias(name))


def with_total(df: DataFrame, key: str, aggs: list[Column], label: str = "__ALL__") -> DataFrame:
    """Rows per key and one total row, labelled by grouping, not by NULL."""
    rolled = df.rollup(key).agg(F.grouping_id().alias("_level"), *aggs)
    named = F.when(F.col("_level") == 1, F.lit(label)).otherwise(F.col(key))
    return rolled.withColumn(key, named).drop("_level")


def coverage(num: Column | str, den: Column | str) -> Column:
    return percent(num, den)


def group_median(df: DataFrame, key: str, x: Column, having: Column, name: str) -> DataFrame:
    """Median over groups of ``x``, an aggregate, kept where ``having`` holds.

    The one or two middle values are taken by rank from ``levels``, which many tasks
    work out together; no task holds all values.
    """
    groups = settle(df.groupBy(key).agg(x.alias("_x"), having.alias("_keep")).filter("_keep").select("_x"))
    n = groups.agg(F.count("_x")).first()[0]
    upper, lower = (F.min(F.when(F.col("rank") <= place, F.col("_x"))) for place in ((n + 1) // 2, n // 2 + 1))
    return levels(groups, "_x").agg(((upper + lower) / 2).cast("double").alias(name))


def count_groups(df: DataFrame, key: str, predicate: Column, name: str) -> DataFrame:
    groups = df.groupBy(key).agg(predicate.alias("_hit"))
    return groups.agg(F.count_if("_hit").alias(name))


def repeat_share(df: DataFrame, who: str, by: list[str], minimum: int, name: str) -> DataFrame:
    """Share of members with at least ``minimum`` rows, per ``by``."""
    per_member = df.groupBy(*by, who).agg(F.count(F.lit(1)).alias("_n"))
    return per_member.groupBy(*by).agg(
        F.try_divide(F.count_if(F.col("_n") >= minimum), F.count(F.lit(1))).alias(name)
    )


def days_since_latest(df: DataFrame, day: str, name: str) -> DataFrame:
    """Days between a row's date and the latest date of the whole table."""
    latest = df.agg(F.max(day)).scalar()
    return df.withColumn(name, F.datediff(latest, F.col(day)))


def histogram(df: DataFrame, c: str, name: str) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias(name))


def acquisition(customers: DataFrame, month: str = "first_order_month", name: str = "new_customers") -> DataFrame:
    """New customers per month of their first order."""
    return customers.groupBy(month).agg(F.count_distinct("customer_sk").alias(name))


def per_site_and_all(per_site: DataFrame, key: str, counts: list[str], label: str = "__ALL__") -> DataFrame:
    """Per-key rows plus their sum as one more row."""
    total = per_site.agg(*[F.sum(c).alias(c) for c in counts]).select(F.lit(label).alias(key), *counts)
    return per_site.select(key, *counts).unionByName(total)
