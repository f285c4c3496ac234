"""Reconciliation of computed figures with the sheet, and coverage gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.clean import tier
from tallyhouse.functions.money import TOTAL, percent, ratio, total_ratio, zero_if_null
from tallyhouse.operators.aggregates import per_site_and_all, with_total
from tallyhouse.operators.joins import covered, flag_member, full_outer_on, unmatched
from tallyhouse.plans.facts import ORDER
from tallyhouse.plans.marts import order_revenue

ALL = "__ALL__"
COVERAGE_BOUNDS, COVERAGE_LABELS = [95, 80], ["green", "yellow"]


def revenue_orders(items: DataFrame) -> DataFrame:
    """Orders with at least one revenue-bearing line."""
    return items.filter("is_revenue_status").select(*ORDER).distinct()


def coverage_tier(num: Column, den: Column) -> Column:
    """Banded on the exact quotient; no revenue orders count as red."""
    exact = (num * 100).cast("decimal(20,6)") / F.nullif(den, F.lit(0)).cast("decimal(20,0)")
    return tier(exact, COVERAGE_BOUNDS, COVERAGE_LABELS, "red")


def recon_cost_coverage(header: DataFrame, items: DataFrame, cost: DataFrame) -> DataFrame:
    """Share of revenue orders with a real cost, per site and over all.

    One row per order carries all flags, so the counts are plain conditional
    counts over a single shuffle on the order.
    """
    flagged = flag_member(header.select(*ORDER, "site_sk"), revenue_orders(items), ORDER, "is_revenue")
    costed = cost.groupBy(*ORDER).agg(F.bool_or(F.coalesce(F.col("cogs_usd") > 0, F.lit(False))).alias("_cogs"))
    orders = flagged.join(costed, ORDER, "left")
    has_cost = F.col("_cogs").isNotNull()
    per_site = orders.groupBy("site_sk").agg(
        F.count(F.lit(1)).alias("woo_orders"),
        F.count_if("is_revenue").alias("revenue_orders"),
        F.count_if(has_cost).alias("covered_orders"),
        F.count_if(has_cost & F.col("is_revenue")).alias("covered_revenue_orders"),
        F.count_if(F.col("_cogs") & F.col("is_revenue")).alias("covered_revenue_orders_with_cogs"),
    )
    counts = [c for c in per_site.columns if c != "site_sk"]
    rows = per_site_and_all(per_site, "site_sk", counts, ALL)
    with_cogs, base = F.col("covered_revenue_orders_with_cogs"), F.col("revenue_orders")
    return rows.select(
        "site_sk",
        *counts,
        percent("covered_orders", "woo_orders").alias("all_order_coverage_pct"),
        percent(with_cogs, base).alias("cost_coverage_pct"),
        percent(with_cogs, base).alias("cogs_coverage_pct"),
        coverage_tier(with_cogs, base).alias("coverage_tier"),
    )


def recon_payment_fee_coverage(header: DataFrame, items: DataFrame) -> DataFrame:
    """Share of orders with a known payment fee, per fee source and over all."""
    base = flag_member(
        header.select(*ORDER, "payment_fee_source", "payment_fee_usd"), revenue_orders(items), ORDER, "is_revenue"
    )
    has_fee = F.col("payment_fee_usd").isNotNull()
    counts = [
        F.count(F.lit(1)).alias("order_count"),
        F.count_if(has_fee).alias("orders_with_fee"),
        F.count_if("is_revenue").alias("revenue_orders"),
        F.count_if(has_fee & F.col("is_revenue")).alias("revenue_orders_with_fee"),
    ]
    return with_total(base, "payment_fee_source", counts, ALL).select(
        "payment_fee_source",
        "order_count",
        "orders_with_fee",
        "revenue_orders",
        "revenue_orders_with_fee",
        percent("orders_with_fee", "order_count").alias("all_order_coverage_pct"),
        percent("revenue_orders_with_fee", "revenue_orders").alias("fee_coverage_pct"),
    )


def recon_csv_vs_dbt_profit(cost: DataFrame, order_profit: DataFrame) -> DataFrame:
    computed = order_profit.select(*ORDER, F.col("contribution_profit_usd").alias("dbt_profit_usd"))
    both = cost.select(*ORDER, "order_sk", "csv_profit_observed_usd").join(computed, ORDER)
    delta = (F.col("csv_profit_observed_usd") - F.col("dbt_profit_usd")).cast(TOTAL)
    return both.select(
        "order_sk",
        "csv_profit_observed_usd",
        "dbt_profit_usd",
        delta.alias("delta_usd"),
        ratio(delta, "dbt_profit_usd").alias("delta_pct"),
    )


def recon_csv_vs_dbt_revenue(cost: DataFrame, items: DataFrame, header: DataFrame) -> DataFrame:
    both = (
        cost.select(*ORDER, "order_sk", "csv_revenue_observed_usd")
        .join(order_revenue(items, "_revenue"), ORDER, "left")
        .join(header.select(*ORDER, "shipping_charged_usd"), ORDER, "left")
    )
    revenue, shipping = zero_if_null("_revenue").cast(TOTAL), zero_if_null("shipping_charged_usd")
    seen = F.col("csv_revenue_observed_usd")
    gross = (revenue + shipping).cast(TOTAL)
    return both.select(
        "order_sk",
        "csv_revenue_observed_usd",
        revenue.alias("dbt_revenue_usd"),
        shipping.alias("shipping_charged_usd"),
        gross.alias("dbt_gross_usd"),
        (seen - revenue).cast(TOTAL).alias("delta_usd"),
        ratio((seen - revenue).cast(TOTAL), revenue).alias("delta_pct"),
        (seen - gross).cast(TOTAL).alias("delta_vs_gross_usd"),
    )


def recon_shipping_charged(header: DataFrame, cost: DataFrame) -> DataFrame:
    """Shipping charged per site and day: the shop's figure for costed orders
    against the sheet's."""
    day = ["site_sk", "date_sk"]
    shop = covered(header, cost, ORDER).groupBy(*day).agg(F.sum("shipping_charged_usd").cast(TOTAL).alias("_shop"))
    sheet = cost.groupBy(*day).agg(F.sum("csv_shipping_charged_usd").cast(TOTAL).alias("_sheet"))
    a, b = zero_if_null("_shop"), zero_if_null("_sheet")
    return full_outer_on(shop, sheet, day).select(
        *day,
        a.cast(TOTAL).alias("woo_shipping_charged_usd"),
        b.cast(TOTAL).alias("csv_shipping_charged_usd"),
        (a - b).cast(TOTAL).alias("delta_usd"),
        total_ratio(a - b, a).alias("delta_pct"),
    )


def recon_unmatched_csv_cost(cost: DataFrame, orders: DataFrame, site: str | None = None) -> DataFrame:
    """Sheet rows no shop order answers to, of one site or of all."""
    rows = cost if site is None else cost.filter(F.col("site_code") == site)
    return unmatched(rows, orders, ORDER).select(
        "site_code",
        F.col("woo_order_id").alias("order_code"),
        "order_date",
        "currency",
        "cogs_usd",
        "design_fee_usd",
        "csv_revenue_observed_usd",
    )
