"""Dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.keys import NO_COUNTRY, country_or_none, date_sk, method_or_none, sk
from tallyhouse.operators.joins import enrich, unmatched
from tallyhouse.operators.setops import union_distinct, union_named

# Labels of products the catalogue does not know.
DELETED_PRODUCT_ID = 0
DELETED_PRODUCT = "(deleted product)"
UNKNOWN_PRODUCT = "(unknown product)"


def calendar_columns(day: Column) -> list[Column]:
    iso = F.weekday(day) + 1
    return [
        date_sk(day).alias("date_sk"),
        day.alias("date_day"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso.alias("iso_day_of_week"),
        F.date_format(day, "E").alias("day_name"),
        iso.isin(6, 7).alias("is_weekend"),
    ]


def _calendar(bounds: DataFrame) -> DataFrame:
    span = F.sequence("first_day", F.date_sub("end_day", 1), F.expr("interval 1 day"))
    return bounds.select(F.explode(span).alias("_day")).select(*calendar_columns(F.col("_day")))


def dim_date(spark: SparkSession, start: str = "2020-01-01", end: str = "2031-01-01") -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    return _calendar(
        spark.range(1).select(
            F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("end_day")
        )
    )


def dim_date_spanning(df: DataFrame, day: str, *more: tuple[DataFrame, str]) -> DataFrame:
    """The calendar of whole years that holds every date of these tables."""
    df = df.select(day)
    for other, other_day in more:
        df = df.unionByName(other.select(F.col(other_day).alias(day)))
    bounds = df.agg(
        F.trunc(F.min(day), "YEAR").alias("first_day"),
        F.add_months(F.trunc(F.max(day), "YEAR"), 12).alias("end_day"),
    )
    return _calendar(bounds)


def dim_site(seed: DataFrame) -> DataFrame:
    return seed.select(
        sk("site_code").alias("site_sk"),
        "site_code",
        "site_name",
        "domain",
        F.upper("default_currency").alias("default_currency"),
        "timezone",
        "reporting_timezone",
        "is_active",
    )


def dim_country(orders: DataFrame, seed: DataFrame) -> DataFrame:
    """Every country ordered from or seeded, and ``XX`` for orders without one."""
    named = seed.groupBy("country_code").agg(
        F.max("country_name").alias("country_name"), F.max("region").alias("region"), F.max("currency").alias("currency")
    )
    ordered = orders.select(country_or_none("billing_country_code").alias("country_code")).distinct()
    codes = union_distinct(ordered, named.select("country_code"))
    code = F.col("country_code")
    bare = F.when(code == NO_COUNTRY, F.lit("Unknown")).otherwise(code)
    return enrich(codes, named, "country_code").select(
        sk("country_code").alias("country_sk"),
        "country_code",
        F.coalesce(F.col("country_name"), bare).alias("country_name"),
        F.coalesce(F.col("region"), F.lit("Unknown")).alias("region"),
        F.upper("currency").alias("currency"),
    )


def dim_payment_method(orders: DataFrame) -> DataFrame:
    methods = orders.groupBy(method_or_none("payment_method").alias("method_code")).agg(
        F.max("payment_method_title").alias("method_name")
    )
    return methods.select(
        sk("method_code").alias("payment_method_sk"),
        "method_code",
        F.coalesce("method_name", "method_code").alias("method_name"),
    )


def dim_product(products: DataFrame, items: DataFrame) -> DataFrame:
    """The catalogue plus one row per product sold that it lacks.

    Lines are reduced to one row per product before they meet the catalogue.
    """
    keys = ["site_code", "woo_product_id"]
    catalogue = products.select(
        *keys, "product_name", "product_url", "product_type", "sku",
        F.col("first_seen_at_utc").cast("date").alias("first_seen_date"),
        F.col("last_seen_at_utc").cast("date").alias("last_seen_date"),
    )
    sold = items.groupBy(*keys).agg(F.max("product_name_at_sale").alias("_name"), F.max("sku").alias("sku"))
    deleted = F.col("woo_product_id") == DELETED_PRODUCT_ID
    absent = unmatched(sold, catalogue, keys).select(
        *keys,
        F.when(deleted, F.lit(DELETED_PRODUCT))
        .otherwise(F.coalesce(F.col("_name"), F.lit(UNKNOWN_PRODUCT)))
        .alias("product_name"),
        F.lit("unknown").alias("product_type"),
        "sku",
    )
    return union_named(catalogue, absent).select(
        sk(*keys).alias("product_sk"),
        sk("site_code").alias("site_sk"),
        *keys, "product_name", "product_url", "product_type", "sku", "first_seen_date", "last_seen_date",
    )


def dim_customer_anonymized(orders: DataFrame) -> DataFrame:
    """One row per customer; the country is that of the first order.

    Orders of the same first day are told apart by order id.
    """
    when = F.struct(F.col("order_date").isNull(), F.col("order_date"), F.col("woo_order_id"))
    people = orders.groupBy("customer_hash").agg(
        F.bool_and("is_unknown_email").alias("is_unknown_email"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.min_by(country_or_none("billing_country_code"), when).alias("_country"),
    )
    return people.select(
        sk("customer_hash").alias("customer_sk"),
        "customer_hash",
        "is_unknown_email",
        sk("_country").alias("country_sk"),
        "first_order_date",
        "last_order_date",
    )
