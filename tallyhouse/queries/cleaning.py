"""Cleaning functions, keys and bands as queries (C, K and P rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import clean, keys
from tallyhouse.functions.money import MONEY, ratio
from tallyhouse.operators.joins import active
from tallyhouse.plans import reports
from tallyhouse.plans.staging import pivot_meta
from tallyhouse.queries import adapter
from tallyhouse.queries.oracle_tables import ratio as sql_ratio
from tallyhouse.queries.oracle_tables import sk as sql_sk
from tallyhouse.queries.registry import query
from tallyhouse.sources import cost_sheet


def texts(r) -> DataFrame:
    """One row per order with awkward cell texts."""
    k, total = F.col("woo_order_id"), F.col("total").cast("string")
    o = adapter.base_orders(r.table("orders"))
    order_date = F.col("created").cast("date")
    return o.select(
        "site_code",
        "woo_order_id",
        "status",
        "created",
        order_date.alias("order_date"),
        "total",
        F.when(k % 4 == 0, F.concat(F.lit("$"), total))
        .when(k % 4 == 1, F.concat(F.lit("($"), total, F.lit(")")))
        .when(k % 4 == 2, F.concat(F.lit(" £-"), total, F.lit(" ")))
        .otherwise(F.lit("nan"))
        .alias("money_text"),
        F.when(k % 5 == 0, F.lit(""))
        .otherwise(F.concat((k % 200 - 100).cast("string"), F.lit(".25%")))
        .alias("percent_text"),
        F.when(k % 6 == 0, F.concat(k.cast("string"), F.lit("_1")))
        .when(k % 6 == 1, F.concat(k.cast("string"), F.lit(".0")))
        .when(k % 6 == 2, F.concat(k.cast("string"), F.lit(".5")))
        .when(k % 6 == 3, F.concat(F.lit("1,"), k.cast("string")))
        .otherwise(k.cast("string"))
        .alias("code_text"),
        F.when(k % 7 == 0, F.lit("n/a"))
        .when(k % 7 == 1, F.lit(""))
        .otherwise(F.date_format(order_date, "MM/dd/yyyy"))
        .alias("date_text"),
    )


KEY = "woo_order_id:i"


def simple(name: str, kind: str, expression: str, build, source: str = "sheet_text"):
    """A query of one computed column per order."""
    query(name, f"{KEY} value:{kind}", f"select k as woo_order_id, {expression} as value from {source}")(
        lambda r: texts(r).select("woo_order_id", build().alias("value"))
    )


@query(
    "c1_fold_headers_drop_pii",
    "woo_order_id:i tips:s has_name:b",
    "select k as woo_order_id, '$' || total as tips, false as has_name from base_order",
)
def _(r):
    """C1 and C2: the accented header is found by its plain name; the name is gone."""
    sheet = adapter.base_orders(r.table("orders")).select(
        "woo_order_id", F.concat(F.lit("$"), F.col("total").cast("string")).alias(" Típs/Coupon "), F.lit("Jane").alias("Name")
    )
    plain = clean.drop_pii(clean.fold_headers(sheet))
    return plain.select("woo_order_id", F.col("`Tips/Coupon`").alias("tips"), F.lit("Name" in plain.columns).alias("has_name"))


@query(
    "c2_drop_pii",
    "woo_order_id:i columns_left:i",
    "select k as woo_order_id, 2 as columns_left from base_order",
)
def _(r):
    sheet = adapter.base_orders(r.table("orders")).select(
        "woo_order_id", "total", *[F.lit("x").alias(h) for h in clean.PII_HEADERS]
    )
    kept = clean.drop_pii(sheet)
    return kept.withColumn("columns_left", F.lit(len(kept.columns)))


simple(
    "c3_parse_money", "m",
    "case k % 4 when 0 then total when 1 then -total when 2 then -total end",
    lambda: clean.parse_money("money_text"),
)
simple(
    "c3_parse_money_large", "m",
    "cast('1234567890123' || (k % 10) || '.45' as decimal(28,6))",
    lambda: clean.parse_money(F.concat(F.lit("$1,234,567,890,123"), (F.col("woo_order_id") % 10).cast("string"), F.lit(".45"))),
)
simple(
    "c4_parse_percent", "r",
    "case when k % 5 <> 0 then case when k % 200 - 100 < 0 then k % 200 - 100 - 0.25 else k % 200 - 100 + 0.25 end / 100.0 end",
    lambda: clean.parse_percent("percent_text"),
)
simple(
    "c5_parse_order_code", "i",
    "case k % 6 when 0 then null when 2 then null when 3 then cast('1' || k as bigint) else k end",
    lambda: clean.parse_order_code("code_text"),
)
simple(
    "c6_parse_order_date", "d",
    "case when k % 7 > 1 then order_date end",
    lambda: clean.parse_order_date("date_text"),
)
simple(
    "c7_clean_cell", "s",
    "case when k % 4 <> 3 then trim(money_text) end",
    lambda: clean.clean_cell("money_text"),
)


@query(
    "c8_row_payload",
    "woo_order_id:i payload:s",
    """select k as woo_order_id, '{' || concat_ws(',', case when k % 4 <> 3 then '"Total":"' || trim(money_text) || '"' end,
'"Order Code":"' || code_text || '"', case when k % 5 <> 0 then '"ROI":"' || percent_text || '"' end) || '}' as payload from sheet_text""",
)
def _(r):
    cells = texts(r).select(
        "woo_order_id", F.col("money_text").alias("Total"), F.col("code_text").alias("Order Code"), F.col("percent_text").alias("ROI")
    )
    return cells.select("woo_order_id", cost_sheet.payload(cells, ["Total", "Order Code", "ROI"]).alias("payload"))


@query(
    "c9_classify_columns",
    "woo_order_id:i order_total_src:m fee_src:m cogs_usd:m csv_roi:r csv_profit_margin:r",
    """select k as woo_order_id, case k % 4 when 0 then total when 1 then -total when 2 then -total end as order_total_src,
null as fee_src, total as cogs_usd,
case when k % 5 <> 0 then case when k % 200 - 100 < 0 then k % 200 - 100 - 0.25 else k % 200 - 100 + 0.25 end / 100.0 end as csv_roi,
null as csv_profit_margin from sheet_text""",
)
def _(r):
    cells = texts(r).select(
        "woo_order_id",
        F.col("money_text").alias("Total"),
        F.concat(F.lit("$"), F.col("total").cast("string")).alias("CoGS"),
        F.col("percent_text").alias("ROI"),
    )
    return cells.select("woo_order_id", *cost_sheet.classify_money(cells))


simple(
    "c10_parse_gmt", "t",
    "case k % 4 when 0 then created when 1 then created when 2 then created - interval 2 hour end",
    lambda: clean.parse_gmt(
        F.when(F.col("woo_order_id") % 4 == 0, adapter.iso(F.col("created")))
        .when(F.col("woo_order_id") % 4 == 1, F.concat(adapter.iso(F.col("created")), F.lit("Z")))
        .when(F.col("woo_order_id") % 4 == 2, F.concat(adapter.iso(F.col("created")), F.lit("+02:00")))
        .otherwise(F.lit("  "))
    ),
    "base_order",
)


@query(
    "c11_json_text",
    "event_id:i k:s missing:s nested:s",
    """select event_id, json_extract_string(props, '$.k') as k, null as missing, json_extract_string(props, '$.k') as nested from events""",
)
def _(r):
    doc = F.concat(F.lit('{"billing":'), F.col("props"), F.lit("}"))
    return r.table("events").select(
        "event_id",
        clean.json_text("props", "k").alias("k"),
        clean.json_text("props", "nope").alias("missing"),
        clean.json_text(doc, "billing.k").alias("nested"),
    )


simple(
    "c12_safe_decimal", "m",
    "case when k % 3 <> 0 then total end",
    lambda: clean.safe_decimal(F.when(F.col("woo_order_id") % 3 == 0, F.lit("")).otherwise(F.col("total").cast("string"))),
)


@query(
    "c13_norm_code",
    "c_custkey:i code:s",
    "select c_custkey, case when c_custkey % 5 <> 0 then upper(c_mktsegment) end as code from customer",
)
def _(r):
    padded = F.when(F.col("c_custkey") % 5 == 0, F.lit("   ")).otherwise(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")))
    return r.table("customer").select("c_custkey", clean.norm_code(padded).alias("code"))


@query(
    "c14_first_segment",
    "p_partkey:i first:s none:s",
    "select p_partkey, p_name as first, null as none from part",
)
def _(r):
    packed = F.concat(F.lit(" "), F.col("p_name"), F.lit(" | "), F.col("p_brand"), F.lit(" | #ffffff"))
    return r.table("part").select(
        "p_partkey", clean.first_segment(packed).alias("first"), clean.first_segment(F.concat(F.lit(" |"), "p_name")).alias("none")
    )


@query(
    "c15_strip_surcharge",
    "p_partkey:i label:s",
    "select p_partkey, case when p_partkey % 4 <> 3 then p_name end as label from part",
)
def _(r):
    k = F.col("p_partkey") % 4
    packed = (
        F.when(k == 0, F.concat("p_name", F.lit(" ($0.00)")))
        .when(k == 1, F.concat("p_name", F.lit(" (£5.95) (£5.95) ")))
        .when(k == 2, F.concat("p_name", F.lit(" (x)|rest (y)")))
        .otherwise(F.lit(" (only) "))
    )
    return r.table("part").select("p_partkey", clean.strip_surcharge(packed).alias("label"))


@query(
    "c16_clamp_quantity",
    "l_orderkey:i quantity:i n:i",
    """select l_orderkey, case when l_returnflag = 'R' then 0 when l_returnflag = 'A' then 0 else cast(l_quantity as int) end as quantity,
count(*) as n from lineitem group by all""",
)
def _(r):
    q = F.col("l_quantity").cast("int")
    raw = F.when(F.col("l_returnflag") == "R", (-q).cast("string")).when(F.col("l_returnflag") != "A", q.cast("string"))
    lines = r.table("lineitem").select("l_orderkey", clean.clamp_quantity(raw).alias("quantity"))
    return lines.groupBy("l_orderkey", "quantity").agg(F.count(F.lit(1)).alias("n"))


simple(
    "c17_refund_magnitude", "m", "total",
    lambda: clean.refund_magnitude(
        F.when(F.col("woo_order_id") % 2 == 0, (-F.col("total")).cast("string")).otherwise(F.col("total").cast("string"))
    ),
)
simple(
    "c18_natural_key", "s", "site_code || '-' || k",
    lambda: F.concat("site_code", F.lit("-"), F.col("woo_order_id").cast("string")),
)


@query(
    "c19_status_flags",
    "woo_order_id:i is_void:b bears_revenue:b",
    """select k as woo_order_id, status in ('cancelled', 'failed') as is_void,
status in ('completed', 'processing', 'refunded') as bears_revenue from base_order""",
)
def _(r):
    return texts(r).select("woo_order_id", clean.is_void("status").alias("is_void"), clean.bears_revenue("status").alias("bears_revenue"))


@query(
    "c20_coalesce_times",
    "woo_product_id:i site_code:s last_seen_at_utc:t",
    "select product_id as woo_product_id, site_code, last_seen as last_seen_at_utc from stg_p",
)
def _(r):
    return r.wh.stg_products


simple("c21_month_start", "d", "date_trunc('month', order_date)", lambda: clean.month_start("order_date"))
simple(
    "c22_round_half_away", "m",
    "round(cast(-total as decimal(28,2)) * 0.125, 2)",
    lambda: F.round(-F.col("total") * F.lit("0.125").cast("decimal(4,3)"), 2),
)
simple(
    "c23_safe_ratio", "r",
    f"case when k % 10 <> 0 then {sql_ratio('total', 'k % 10')} end",
    lambda: ratio("total", (F.col("woo_order_id") % 10).cast(MONEY)),
)


# --- keys --------------------------------------------------------------------


@query(
    "k1_surrogate_key",
    "woo_order_id:i one:s two:s with_null:s",
    f"""select k as woo_order_id, {sql_sk('site_code')} as one, {sql_sk('site_code', 'k')} as two,
{sql_sk('site_code', 'k', 'cast(null as varchar)')} as with_null from base_order""",
)
def _(r):
    return texts(r).select(
        "woo_order_id",
        keys.sk("site_code").alias("one"),
        keys.sk("site_code", "woo_order_id").alias("two"),
        keys.sk("site_code", "woo_order_id", F.lit(None)).alias("with_null"),
    )


@query(
    "k2_hash_pii",
    "c_custkey:i hashed:s",
    "select c_custkey, case when c_custkey % 6 <> 0 then sha256(lower(c_name) || 'pepper') end as hashed from customer",
)
def _(r):
    email = F.when(F.col("c_custkey") % 6 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.upper("c_name")))
    return r.table("customer").select("c_custkey", keys.hash_pii(email, adapter.SALT).alias("hashed"))


@query(
    "k3_customer_hash",
    "woo_order_id:i customer_hash:s is_unknown_email:b",
    "select k as woo_order_id, customer_hash, is_unknown_email from stg_o",
)
def _(r):
    return r.star.stg_orders


simple("k4_date_key", "i", "cast(strftime(order_date, '%Y%m%d') as int)", lambda: keys.date_sk("order_date"))


# --- projections and bands ---------------------------------------------------


@query(
    "p8_pivot_meta",
    "woo_order_id:i stripe:s paypal:s absent:s",
    "select k as woo_order_id, stripe_fee as stripe, paypal_fee as paypal, null as absent from stg_o",
)
def _(r):
    meta = F.from_json(clean.json_text("_payload", "meta_data"), "array<struct<key:string,value:string>>")
    return r.wh.inputs.orders.select("woo_order_id", meta.alias("meta")).select(
        "woo_order_id",
        pivot_meta(F.col("meta"), "key", "_cs_stripe_fee").alias("stripe"),
        pivot_meta(F.col("meta"), "key", "_cs_paypal_fee").alias("paypal"),
        pivot_meta(F.col("meta"), "key", "nope").alias("absent"),
    )


@query(
    "p9_active_seed_rows",
    "payment_method:s fee_percent:m orders:i",
    """select payment_method, case payment_method when '1-URGENT' then 0.029 else 0.019 end as fee_percent, count(*) as orders
from stg_o where payment_method in ('1-URGENT', '2-HIGH') group by all""",
)
def _(r):
    methods = r.star.stg_orders.groupBy("payment_method").agg(F.count(F.lit(1)).alias("orders"))
    return methods.join(active(r.wh.inputs.fees), "payment_method")


@query(
    "p11_resolve_fee",
    "woo_order_id:i payment_fee_usd:m payment_fee_source:s payment_fee_needs_review:b",
    "select k as woo_order_id, payment_fee_usd, fee_source as payment_fee_source, fee_source = 'missing' as payment_fee_needs_review from f_order",
)
def _(r):
    return r.model("fact_order")


@query("p12_refund_event_type", "woo_refund_id:i event_type:s", "select refund_id as woo_refund_id, event_type from f_refund")
def _(r):
    return r.model("fact_refund")


simple(
    "p13_tier", "s",
    "case when k % 7 = 0 then 'red' when k % 100 >= 95 then 'green' when k % 100 >= 80 then 'yellow' else 'red' end",
    lambda: clean.tier(
        F.when(F.col("woo_order_id") % 7 != 0, F.col("woo_order_id") % 100), [95, 80], ["green", "yellow"], "red"
    ),
)


@query(
    "p15_margin_band",
    "country_name:s margin_band:s",
    f"""select country_name, case when m >= 0.56 then 'green' when m >= 0.53 then 'sand' else 'red' end as margin_band from
(select country_name, {sql_ratio('sum(profit)', 'sum(net)')} as m from m_order join d_country using (country_sk) group by 1)""",
)
def _(r):
    return reports.margin_bands(r.star)


@query(
    "p16_month_start_column",
    "month_start:d days:i orders:i",
    "select date_trunc('month', order_date) as month_start, count(distinct order_date) as days, count(*) as orders from base_order group by 1",
)
def _(r):
    dates = r.star.dim_date.select("date_sk", clean.month_start("date_day").alias("month_start"))
    per_day = r.star.fact_order.groupBy("date_sk").agg(F.count(F.lit(1)).alias("n"))
    return per_day.join(dates, "date_sk").groupBy("month_start").agg(F.count(F.lit(1)).alias("days"), F.sum("n").alias("orders"))
