"""Facts. Besides their published columns they carry ``site_code`` and
``woo_order_id``: joins between facts hash these two short columns, not the
32-character key text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.clean import bears_revenue, is_void
from tallyhouse.functions.keys import country_or_none, date_sk, method_or_none, sk
from tallyhouse.functions.money import MONEY, convert, money
from tallyhouse.operators.joins import INHERITED, fx_convert, rate_or_one, with_fee_seed, with_header, with_rate

ORDER = ["site_code", "woo_order_id"]
PRODUCT = ["site_code", "woo_product_id"]


def resolve_fee(df: DataFrame) -> DataFrame:
    """Payment fee, its source, and whether someone should look at it.

    The plugin's own figure first, then an estimate from the fee terms, else none.
    """
    plugin = F.when(
        F.col("has_plugin_payment_fee"), convert("plugin_payment_fee_src", rate_or_one("fee_rate"))
    )
    total = F.coalesce(money("order_total_src"), F.lit(0).cast(MONEY)) * F.col("fx_rate_to_usd")
    terms = total * F.col("fee_percent").cast("decimal(9,6)")
    estimated = ~F.col("has_plugin_payment_fee") & F.col("fee_percent").isNotNull()
    fixed = F.coalesce(F.col("fixed_fee_usd").cast(MONEY), F.lit(0).cast(MONEY))
    estimate = F.when(estimated, F.round(terms + fixed, 6).cast(MONEY))
    priced = df.withColumn("_estimate", estimate)
    return priced.select(
        "*",
        F.coalesce(plugin, "_estimate").alias("payment_fee_usd"),
        F.when(F.col("has_plugin_payment_fee"), "plugin_parser")
        .when(F.col("_estimate").isNotNull(), "seed_estimate")
        .otherwise("missing")
        .alias("payment_fee_source"),
        (~F.col("has_plugin_payment_fee") & F.col("_estimate").isNull()).alias("payment_fee_needs_review"),
    )


def fact_order(orders: DataFrame, fx: DataFrame, fees: DataFrame) -> DataFrame:
    """Order header: keys, dollars at the order date, payment fee. No revenue here.

    Orders may bring their ``customer_sk`` along, made of ``customer_hash``.
    """
    customer = F.col("customer_sk") if "customer_sk" in orders.columns else sk("customer_hash")
    rated = with_rate(orders, fx, "currency_source", "order_date", "_order_rate")
    rated = with_rate(rated, fx, "plugin_payment_fee_currency", "order_date", "fee_rate")
    rated = rated.withColumn("fx_rate_to_usd", rate_or_one("_order_rate"))
    priced = resolve_fee(with_fee_seed(rated, fees))
    dollars = [
        c
        for name in ("order_total", "shipping_charged", "discount", "tax")
        for c in (F.col(f"{name}_src"), convert(f"{name}_src", "fx_rate_to_usd").alias(f"{name}_usd"))
    ]
    return priced.select(
        sk(*ORDER).alias("order_sk"),
        sk("site_code").alias("site_sk"),
        date_sk("order_date").alias("date_sk"),
        customer.alias("customer_sk"),
        sk(country_or_none("billing_country_code")).alias("country_sk"),
        sk(method_or_none("payment_method")).alias("payment_method_sk"),
        "order_natural_key",
        *ORDER,
        "order_date",
        "status",
        "status_is_cancelled",
        "currency_source",
        "fx_rate_to_usd",
        *dollars,
        "payment_fee_usd",
        "payment_fee_source",
        "payment_fee_needs_review",
        F.lit(1).alias("order_count"),
    )


def fact_order_item(items: DataFrame, header: DataFrame) -> DataFrame:
    """Order lines: the one place revenue lives.

    Currency, date, status and foreign keys all come from the header, and so does
    the rate (same currency, same date), so one join serves for all of them.
    """
    taken = ["order_sk", "site_sk", "date_sk", "status", "fx_rate_to_usd", *INHERITED]
    lines = with_header(items, header, taken)
    rate = rate_or_one("fx_rate_to_usd")
    return lines.select(
        sk(*ORDER, "woo_order_item_id").alias("order_item_sk"),
        F.coalesce("order_sk", sk(*ORDER)).alias("order_sk"),
        F.coalesce("site_sk", sk("site_code")).alias("site_sk"),
        "date_sk",
        sk(*PRODUCT).alias("product_sk"),
        *INHERITED,
        *ORDER,
        F.col("woo_order_item_id").alias("woo_line_item_id"),
        "woo_product_id",
        "quantity",
        "unit_price_src",
        "line_subtotal_src",
        "line_total_src",
        rate.alias("fx_rate_to_usd"),
        convert("line_total_src", rate).alias("line_revenue_usd"),
        F.col("status").alias("order_status"),
        bears_revenue("status").alias("is_revenue_status"),
        "size",
        "color",
        "style",
        "fit_type",
        "print_location",
    )


def fact_refund(refunds: DataFrame, header: DataFrame, fx: DataFrame) -> DataFrame:
    """Refunds per order, in dollars at the refund date."""
    known = with_header(refunds, header, ["status", "currency_source", *INHERITED])
    priced = fx_convert(known, fx, "currency_source", "refund_date", {"refund_amount_usd": "refund_amount_src"})
    return priced.select(
        sk("site_code", "woo_refund_id").alias("refund_sk"),
        sk(*ORDER).alias("order_sk"),
        sk("site_code").alias("site_sk"),
        *INHERITED,
        F.lit(None).cast("string").alias("order_item_sk"),
        date_sk("refund_date").alias("date_sk"),
        *ORDER,
        "woo_refund_id",
        "refund_amount_usd",
        "refund_reason",
        F.when(is_void("status"), "cancellation").otherwise("refund").alias("event_type"),
    )


def fact_order_cost(cost: DataFrame, header: DataFrame, fx: DataFrame) -> DataFrame:
    """Sheet costs of known orders; the rate follows the sheet's currency and the
    shop's order date."""
    shop = header.select(*ORDER, "order_sk", "site_sk", "date_sk", F.col("order_date").alias("_shop_date"), *INHERITED)
    matched = cost.join(shop, ORDER)
    amounts = {"payment_fee_fallback_usd": "fee_src", "csv_shipping_charged_usd": "csv_shipping_charged_src"}
    priced = fx_convert(matched, fx, F.upper("currency"), "_shop_date", amounts)
    return priced.select(
        F.col("order_sk").alias("order_cost_sk"),
        "order_sk",
        "site_sk",
        "date_sk",
        *INHERITED,
        *ORDER,
        "cogs_usd",
        "design_fee_usd",
        "payment_fee_fallback_usd",
        "csv_shipping_charged_usd",
        "csv_revenue_observed_usd",
        "csv_profit_observed_usd",
        "cost_source",
        "cost_allocation_method",
        "cost_confidence",
    )
