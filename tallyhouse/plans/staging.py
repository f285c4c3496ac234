"""Raw rows to typed, anonymised rows. Every model is a projection: no shuffle.

A payload is parsed once into just the fields used; key/value lists are pivoted
inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.clean import (
    clamp_quantity, first_segment, is_void, norm_code, parse_gmt, refund_magnitude, safe_decimal, strip_surcharge,
)
from tallyhouse.functions.keys import customer_hash, hash_pii
from tallyhouse.functions.money import MONEY

ORDER_FIELDS = (
    "struct<number:string,currency:string,payment_method:string,payment_method_title:string,"
    "total:string,shipping_total:string,discount_total:string,total_tax:string,"
    "billing:struct<country:string,email:string>,meta_data:array<struct<key:string,value:string>>>"
)
ITEM_FIELDS = (
    "struct<product_id:string,name:string,sku:string,quantity:string,price:string,subtotal:string,"
    "total:string,meta_data:array<struct<display_key:string,value:string>>>"
)
PRODUCT_FIELDS = (
    "struct<name:string,permalink:string,type:string,sku:string,status:string,"
    "date_created_gmt:string,date_modified_gmt:string>"
)
REFUND_FIELDS = "struct<amount:string,reason:string>"
CUSTOMER_FIELDS = "struct<email:string,billing:struct<country:string>,date_created_gmt:string>"
COUPON_FIELDS = (
    "struct<code:string,discount_type:string,amount:string,date_created_gmt:string,date_modified_gmt:string>"
)

# Payment plugin keys of an order and attribute labels of a line.
STRIPE_FEE, STRIPE_CURRENCY = "_cs_stripe_fee", "_cs_stripe_currency"
PAYPAL_FEE, PAYPAL_CURRENCY = "_cs_paypal_fee", "_cs_paypal_currency"
ATTRIBUTES = {
    "Size": "size",
    "Color": "color",
    "Style": "style",
    "Fit Type": "fit_type",
    "Print on the": "print_location",
}


def parsed(raw: DataFrame, fields: str) -> DataFrame:
    return raw.withColumn("p", F.from_json("_payload", fields))


def pivot_meta(entries: Column, name_field: str, key: str) -> Column:
    """Highest value stored under a key of a key/value list, NULL when absent.

    A list that names no key twice, as nearly all do, is looked up in generated code; the
    others are filtered with lambdas, which are not compiled.
    """
    names = entries.getField(name_field)
    only = F.get(entries.getField("value"), (F.array_position(names, key) - 1).cast("int"))
    hits = F.filter(entries, lambda m: m.getField(name_field) == key)
    highest = F.array_max(F.transform(hits, lambda m: m.getField("value")))
    return F.when(F.size(F.array_distinct(names)) == F.size(names), only).otherwise(highest)


def stg_orders(raw: DataFrame, salt: str) -> DataFrame:
    doc = parsed(raw, ORDER_FIELDS)
    meta = F.col("p.meta_data")
    typed = doc.select(
        "site_code",
        "woo_order_id",
        F.concat("site_code", F.lit("-"), F.col("woo_order_id").cast("string")).alias("order_natural_key"),
        F.col("p.number").alias("order_number"),
        "status",
        is_void("status").alias("status_is_cancelled"),
        F.upper(F.coalesce("currency", "p.currency")).alias("currency_source"),
        F.col("date_created_gmt").alias("order_created_at_utc"),
        F.col("date_created_gmt").cast("date").alias("order_date"),
        F.col("p.payment_method").alias("payment_method"),
        F.col("p.payment_method_title").alias("payment_method_title"),
        norm_code("p.billing.country").alias("billing_country_code"),
        safe_decimal("p.total").alias("order_total_src"),
        safe_decimal("p.shipping_total").alias("shipping_charged_src"),
        safe_decimal("p.discount_total").alias("discount_src"),
        safe_decimal("p.total_tax").alias("tax_src"),
        hash_pii("p.billing.email", salt).alias("billing_email_hash"),
        (F.coalesce(F.trim("p.billing.email"), F.lit("")) == "").alias("is_unknown_email"),
        safe_decimal(pivot_meta(meta, "key", STRIPE_FEE)).alias("stripe_fee_src"),
        safe_decimal(pivot_meta(meta, "key", PAYPAL_FEE)).alias("paypal_fee_src"),
        F.upper(pivot_meta(meta, "key", STRIPE_CURRENCY)).alias("stripe_currency"),
        F.upper(pivot_meta(meta, "key", PAYPAL_CURRENCY)).alias("paypal_currency"),
    )
    stripe, paypal = F.col("stripe_fee_src"), F.col("paypal_fee_src")
    return typed.select(
        "*",
        F.coalesce(stripe, paypal).alias("plugin_payment_fee_src"),
        F.when(stripe.isNotNull(), F.col("stripe_currency"))
        .when(paypal.isNotNull(), F.col("paypal_currency"))
        .alias("plugin_payment_fee_currency"),
        (stripe.isNotNull() | paypal.isNotNull()).alias("has_plugin_payment_fee"),
        customer_hash("billing_email_hash", "site_code", "woo_order_id").alias("customer_hash"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    doc = parsed(raw, ITEM_FIELDS)
    meta = F.col("p.meta_data")
    value = {name: pivot_meta(meta, "display_key", label) for label, name in ATTRIBUTES.items()}
    clean = {name: strip_surcharge if name == "print_location" else first_segment for name in value}
    return doc.select(
        "site_code",
        "woo_order_id",
        "woo_order_item_id",
        F.col("p.product_id").cast("bigint").alias("woo_product_id"),
        F.col("p.name").alias("product_name_at_sale"),
        F.col("p.sku").alias("sku"),
        clamp_quantity("p.quantity").alias("quantity"),
        safe_decimal("p.price").alias("unit_price_src"),
        safe_decimal("p.subtotal").alias("line_subtotal_src"),
        safe_decimal("p.total").alias("line_total_src"),
        *[clean[name](value[name]).alias(name) for name in value],
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return parsed(raw, PRODUCT_FIELDS).select(
        "site_code",
        "woo_product_id",
        F.col("p.name").alias("product_name"),
        F.col("p.permalink").alias("product_url"),
        F.col("p.type").alias("product_type"),
        F.col("p.sku").alias("sku"),
        F.col("p.status").alias("product_status"),
        parse_gmt("p.date_created_gmt").alias("first_seen_at_utc"),
        F.coalesce(parse_gmt("p.date_modified_gmt"), "date_modified_gmt").alias("last_seen_at_utc"),
    )


def stg_refunds(raw: DataFrame) -> DataFrame:
    return parsed(raw, REFUND_FIELDS).select(
        "site_code",
        "woo_refund_id",
        "woo_order_id",
        refund_magnitude("p.amount").alias("refund_amount_src"),
        F.nullif(F.trim("p.reason"), F.lit("")).alias("refund_reason"),
        F.col("date_created_gmt").alias("refund_created_at_utc"),
        F.col("date_created_gmt").cast("date").alias("refund_date"),
    )


def stg_customers(raw: DataFrame, salt: str) -> DataFrame:
    return parsed(raw, CUSTOMER_FIELDS).select(
        "site_code",
        "woo_customer_id",
        hash_pii("p.email", salt).alias("customer_email_hash"),
        norm_code("p.billing.country").alias("billing_country_code"),
        parse_gmt("p.date_created_gmt").alias("created_at_utc"),
    )


def stg_coupons(raw: DataFrame) -> DataFrame:
    return parsed(raw, COUPON_FIELDS).select(
        "site_code",
        "woo_coupon_id",
        F.nullif(F.trim("p.code"), F.lit("")).alias("coupon_code"),
        F.col("p.discount_type").alias("discount_type"),
        safe_decimal("p.amount").alias("amount"),
        parse_gmt("p.date_created_gmt").alias("created_at_utc"),
        F.coalesce(parse_gmt("p.date_modified_gmt"), "date_modified_gmt").alias("modified_at_utc"),
    )


def stg_cost(sheet: DataFrame) -> DataFrame:
    return sheet.select(
        "site_code",
        "woo_order_id",
        "currency",
        "order_date",
        "cogs_usd",
        "design_fee_usd",
        "fee_src",
        "csv_shipping_charged_src",
        "csv_revenue_observed_usd",
        "csv_profit_observed_usd",
        F.lit("manual_csv").alias("cost_source"),
        F.lit("order_only").alias("cost_allocation_method"),
        F.lit("1.00").cast(MONEY).alias("cost_confidence"),
    )
