"""Profit per order, profit per line, customer summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.clean import month_start, tier
from tallyhouse.functions.keys import country_or_none, sk
from tallyhouse.functions.money import MONEY, TOTAL, ratio, zero_if_null
from tallyhouse.operators.aggregates import days_since_latest, per_order
from tallyhouse.operators.joins import INHERITED
from tallyhouse.plans.facts import ORDER


def order_revenue(items: DataFrame, name: str) -> DataFrame:
    """Product revenue per order over revenue-bearing lines."""
    return per_order(items.filter("is_revenue_status"), "line_revenue_usd", name)


def order_refunds(refunds: DataFrame, name: str = "_refunds") -> DataFrame:
    return per_order(refunds, "refund_amount_usd", name)


def mart_order_profit(cost: DataFrame, header: DataFrame, items: DataFrame, refunds: DataFrame) -> DataFrame:
    """Contribution profit of every costed order that sold something.

    Lines and refunds are summed per order before any join, so a join sees at most
    one row per order on each side.
    """
    sold = order_revenue(items, "_product").filter(F.col("_product") > 0)
    head = header.select(
        *ORDER, "shipping_charged_usd", "payment_fee_usd", "payment_fee_source", F.col("status").alias("order_status")
    )
    known = cost.join(head, ORDER).join(sold, ORDER).join(order_refunds(refunds), ORDER, "left")

    terms = known.select(
        "*",
        F.col("_product").alias("product"),
        zero_if_null("shipping_charged_usd").cast(MONEY).alias("shipping"),
        zero_if_null("_refunds").cast(TOTAL).alias("refunded"),
        F.coalesce("payment_fee_usd", "payment_fee_fallback_usd", F.lit(0)).cast(MONEY).alias("fee"),
    )
    terms = terms.withColumn("gross", (F.col("product") + F.col("shipping")).cast(TOTAL))
    terms = terms.withColumn("applied", F.least("refunded", "gross").cast(TOTAL))
    terms = terms.withColumn("net", (F.col("gross") - F.col("applied")).cast(TOTAL))
    left = F.col("net") - zero_if_null("cogs_usd") - zero_if_null("design_fee_usd") - F.col("fee")
    terms = terms.withColumn("profit", left.cast(TOTAL))

    return terms.select(
        "order_sk",
        "site_sk",
        "date_sk",
        *ORDER,
        F.col("product").alias("gross_product_revenue_usd"),
        F.col("shipping").alias("shipping_charged_usd"),
        F.col("gross").alias("gross_revenue_usd"),
        F.col("refunded").alias("refunds_usd"),
        F.col("applied").alias("effective_refund_usd"),
        F.col("net").alias("net_revenue_usd"),
        F.col("net").alias("revenue_usd"),
        "cogs_usd",
        "design_fee_usd",
        F.col("fee").alias("payment_fee_usd"),
        F.col("profit").alias("contribution_profit_usd"),
        ratio("profit", "net").alias("profit_margin"),
        "cost_confidence",
        "cost_allocation_method",
        "payment_fee_source",
        *INHERITED,
        "order_status",
    )


def mart_product_profit(items: DataFrame, order_profit: DataFrame) -> DataFrame:
    """Order totals spread over the lines by their share of the order's revenue.

    Whether an order bears revenue is a property of the order, so its product
    revenue in the profit mart equals the sum over all its lines: it serves as the
    denominator, and no second pass over the lines is needed.
    """
    spread = {
        "_ship": "shipping_charged_usd",
        "_refund": "effective_refund_usd",
        "_cogs": "cogs_usd",
        "_design": "design_fee_usd",
        "_fee": "payment_fee_usd",
    }
    totals = order_profit.select(
        *ORDER,
        F.col("gross_product_revenue_usd").alias("_order_revenue"),
        *[zero_if_null(src).cast(TOTAL).alias(name) for name, src in spread.items()],
    )
    lines = items.join(totals, ORDER)

    # a share keeps twenty decimals and its product with a total sixteen, so the
    # spread amounts are exact well beyond their six places
    share = F.col("line_revenue_usd").cast(MONEY) / F.col("_order_revenue").cast(TOTAL)
    lines = lines.withColumn("_share", share.cast("decimal(24,20)"))

    def part(total: Column) -> Column:
        return total.cast("decimal(23,6)") * F.col("_share")

    money_in = F.col("_ship") - F.col("_refund")
    money_out = F.col("_cogs") + F.col("_design") + F.col("_fee")
    net = F.col("line_revenue_usd") + part(money_in)
    profit = F.col("line_revenue_usd") + part(money_in - money_out)

    def cut(x: Column, name: str) -> Column:
        return F.round(x, 6).cast(MONEY).alias(name)

    return lines.select(
        "order_item_sk",
        "order_sk",
        "site_sk",
        "date_sk",
        "product_sk",
        *INHERITED,
        *ORDER,
        "order_status",
        "woo_line_item_id",
        "woo_product_id",
        "quantity",
        "line_revenue_usd",
        cut(part(F.col("_ship")), "line_shipping_usd"),
        cut(part(F.col("_refund")), "line_refund_usd"),
        cut(net, "line_net_revenue_usd"),
        cut(part(F.col("_cogs")), "line_cogs_usd"),
        cut(part(F.col("_design")), "line_design_fee_usd"),
        cut(part(F.col("_fee")), "line_payment_fee_usd"),
        cut(profit, "line_profit_usd"),
        F.lit("allocated_by_revenue_share").alias("cost_allocation_method"),
        F.lit("0.60").cast(MONEY).alias("cost_confidence"),
        "is_revenue_status",
    )


def customer_orders(
    orders: DataFrame, header: DataFrame, items: DataFrame, refunds: DataFrame, order_profit: DataFrame
) -> DataFrame:
    """One row per order with what it brought in, net of refunds, never below zero."""
    base = orders.select(*ORDER, "customer_hash", "order_date", country_or_none("billing_country_code").alias("country_code"))
    joined = (
        base.join(header.select(*ORDER, "shipping_charged_usd"), ORDER, "left")
        .join(order_revenue(items, "_product"), ORDER, "left")
        .join(order_refunds(refunds), ORDER, "left")
        .join(order_profit.select(*ORDER, "contribution_profit_usd"), ORDER, "left")
    )
    product = zero_if_null("_product")
    shipping = F.when(product > 0, zero_if_null("shipping_charged_usd")).otherwise(F.lit(0))
    revenue = F.greatest(product + shipping - zero_if_null("_refunds"), F.lit(0)).cast(TOTAL)
    return joined.select(
        *ORDER,
        "customer_hash",
        "order_date",
        "country_code",
        revenue.alias("order_revenue_usd"),
        F.col("contribution_profit_usd").alias("order_profit_usd"),
    )


def mart_customer_summary(
    orders: DataFrame, items: DataFrame, refunds: DataFrame, header: DataFrame, order_profit: DataFrame
) -> DataFrame:
    """Behaviour per customer. All orders count, also void ones.

    Every order is one input row, so counting rows counts distinct orders.
    """
    per_customer = customer_orders(orders, header, items, refunds, order_profit).groupBy("customer_hash").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("order_revenue_usd").cast(TOTAL).alias("total_revenue_usd"),
        F.sum("order_profit_usd").cast(TOTAL).alias("total_profit_usd"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.mode("site_code", True).alias("_site"),
        F.mode("country_code", True).alias("_country"),
    )
    return summary_columns(per_customer)


def summary_columns(per_customer: DataFrame) -> DataFrame:
    """The published columns of customers with their totals and most frequent places."""
    return per_customer.select(
        sk("customer_hash").alias("customer_sk"),
        "customer_hash",
        "first_order_date",
        month_start("first_order_date").alias("first_order_month"),
        "last_order_date",
        "total_orders",
        "total_revenue_usd",
        "total_profit_usd",
        (F.col("total_orders") > 1).alias("is_repeat"),
        sk("_site").alias("preferred_site_sk"),
        sk("_country").alias("preferred_country_sk"),
    )


# Customer bands.
RECENCY_BOUNDS, RECENCY_LABELS = [90, 180, 365], ["Active 0-3mo", "3-6 mo", "6-12 mo"]
CLV_BOUNDS, CLV_LABELS = [20, 40, 75, 150], ["1. <$20", "2. $20-40", "3. $40-75", "4. $75-150"]


def customer_bands(summary: DataFrame) -> DataFrame:
    """Recency, lifetime value and repeat bands beside the summary."""
    dated = days_since_latest(summary, "last_order_date", "days_since_last_order")
    return dated.select(
        "*",
        tier(F.col("days_since_last_order"), RECENCY_BOUNDS, RECENCY_LABELS, "Lapsed 12+mo", descending=False)
        .alias("recency_segment"),
        tier(F.col("total_revenue_usd"), CLV_BOUNDS, CLV_LABELS, "5. $150+", descending=False).alias("clv_bucket"),
        F.when(F.col("is_repeat"), "Repeat").otherwise("One-time").alias("segment"),
    )
