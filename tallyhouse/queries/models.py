"""Staging, dimensions, facts, marts, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.plans import customers, recon, staging
from tallyhouse.plans.dims import dim_date_spanning
from tallyhouse.plans.marts import customer_bands, customer_orders
from tallyhouse.queries import adapter
from tallyhouse.queries.oracle_tables import ratio, sk
from tallyhouse.queries.registry import query
from tallyhouse.session import settle

# --- staging -----------------------------------------------------------------


@query(
    "p1_stg_orders",
    "site_code:s woo_order_id:i order_natural_key:s order_number:s status:s status_is_cancelled:b currency_source:s "
    "order_created_at_utc:t order_date:d payment_method:s payment_method_title:s billing_country_code:s "
    "order_total_src:m shipping_charged_src:m discount_src:m tax_src:m billing_email_hash:s is_unknown_email:b "
    "stripe_fee_src:m paypal_fee_src:m stripe_currency:s paypal_currency:s plugin_payment_fee_src:m "
    "plugin_payment_fee_currency:s has_plugin_payment_fee:b customer_hash:s",
    """select site_code, k as woo_order_id, order_natural_key, k as order_number, status,
status in ('cancelled', 'failed') as status_is_cancelled, ccy as currency_source, created as order_created_at_utc,
order_date, payment_method, payment_method_title, country as billing_country_code, total as order_total_src,
shipping_src as shipping_charged_src, discount_src, tax_src, email_hash as billing_email_hash, is_unknown_email,
stripe_fee as stripe_fee_src, paypal_fee as paypal_fee_src, case when stripe_fee is not null then ccy end as stripe_currency,
case when paypal_fee is not null then 'USD' end as paypal_currency, coalesce(stripe_fee, paypal_fee) as plugin_payment_fee_src,
case when stripe_fee is not null then ccy when paypal_fee is not null then 'USD' end as plugin_payment_fee_currency,
coalesce(stripe_fee, paypal_fee) is not null as has_plugin_payment_fee, customer_hash from stg_o""",
)
def _(r):
    return r.wh.stg_orders


@query(
    "p2_stg_order_items",
    "site_code:s woo_order_id:i woo_order_item_id:i woo_product_id:i product_name_at_sale:s sku:s quantity:i "
    "unit_price_src:m line_subtotal_src:m line_total_src:m size:s color:s style:s fit_type:s print_location:s",
    """select site_code, k as woo_order_id, item_id as woo_order_item_id, product_id as woo_product_id,
name as product_name_at_sale, sku, quantity, unit_price as unit_price_src, subtotal as line_subtotal_src,
total as line_total_src, size, color, style, fit_type, print_location from stg_i""",
)
def _(r):
    return r.wh.stg_order_items


@query(
    "p3_stg_products",
    "site_code:s woo_product_id:i product_name:s product_url:s product_type:s sku:s product_status:s "
    "first_seen_at_utc:t last_seen_at_utc:t",
    """select site_code, product_id as woo_product_id, name as product_name, url as product_url, 'simple' as product_type,
sku, 'publish' as product_status, first_seen as first_seen_at_utc, last_seen as last_seen_at_utc from stg_p""",
)
def _(r):
    return r.wh.stg_products


@query(
    "p4_stg_refunds",
    "site_code:s woo_refund_id:i woo_order_id:i refund_amount_src:m refund_reason:s refund_created_at_utc:t refund_date:d",
    """select site_code, refund_id as woo_refund_id, k as woo_order_id, amount as refund_amount_src, reason as refund_reason,
refunded_at as refund_created_at_utc, refund_date from stg_r""",
)
def _(r):
    return r.wh.stg_refunds


@query(
    "p5_stg_customers",
    "site_code:s woo_customer_id:i customer_email_hash:s billing_country_code:s created_at_utc:t",
    """select 'S' || (c_custkey % 5) as site_code, c_custkey as woo_customer_id,
case when c_custkey % 9 <> 0 then sha256(lower(c_name || '@x.test') || 'pepper') end as customer_email_hash,
case when c_custkey % 8 <> 0 then n_name end as billing_country_code, timestamp '1994-05-06 07:08:09' as created_at_utc
from customer join nation on c_nationkey = n_nationkey""",
)
def _(r):
    return r.wh.stg_customers


@query(
    "p6_stg_coupons",
    "site_code:s woo_coupon_id:i coupon_code:s discount_type:s amount:m created_at_utc:t modified_at_utc:t",
    """select 'S' || (s_suppkey % 5) as site_code, s_suppkey as woo_coupon_id,
case when s_suppkey % 4 <> 0 then s_name end as coupon_code,
case when s_suppkey % 2 = 0 then 'percent' else 'fixed_cart' end as discount_type,
case when s_suppkey % 5 <> 0 then cast(s_acctbal as decimal(18,2)) end as amount,
timestamp '1999-01-02 03:04:05' as created_at_utc,
case when s_suppkey % 3 = 0 then timestamp '2001-01-01 00:00:00' else timestamp '2000-02-03 04:05:06' end as modified_at_utc
from supplier""",
)
def _(r):
    return r.wh.stg_coupons


@query(
    "p7_stg_cost",
    "site_code:s woo_order_id:i currency:s order_date:d cogs_usd:m design_fee_usd:m fee_src:m csv_shipping_charged_src:m "
    "csv_revenue_observed_usd:m csv_profit_observed_usd:m cost_source:s cost_allocation_method:s cost_confidence:m",
    """select site_code, k as woo_order_id, ccy as currency, order_date, cogs_usd, design_fee_usd, fee_src,
ship_src as csv_shipping_charged_src, revenue_observed as csv_revenue_observed_usd, profit_observed as csv_profit_observed_usd,
'manual_csv' as cost_source, 'order_only' as cost_allocation_method, 1.0 as cost_confidence from stg_c""",
)
def _(r):
    return r.wh.stg_cost


# --- dimensions --------------------------------------------------------------


@query(
    "m1_dim_date",
    "date_sk:i date_day:d year:i quarter:i month:i month_name:s day_of_month:i iso_day_of_week:i day_name:s is_weekend:b",
    """select cast(strftime(d, '%Y%m%d') as int) as date_sk, d as date_day, year(d) as year, quarter(d) as quarter,
month(d) as month, strftime(d, '%b') as month_name, day(d) as day_of_month, isodow(d) as iso_day_of_week,
strftime(d, '%a') as day_name, isodow(d) in (6, 7) as is_weekend
from (with days as (select order_date as d from base_order union all select refund_date from stg_r) select cast(unnest(generate_series(
  (select date_trunc('year', min(d)) from days)::timestamp,
  (select date_trunc('year', max(d)) + interval 1 year - interval 1 day from days)::timestamp,
  interval 1 day)) as date) as d)""",
)
def _(r):
    orders = r.table("orders").select(F.col("o_orderdate").cast("date").alias("order_date"))
    return dim_date_spanning(orders, "order_date", (r.wh.stg_refunds, "refund_date"))


@query(
    "m2_dim_site",
    "site_sk:s site_code:s site_name:s domain:s default_currency:s timezone:s reporting_timezone:s is_active:b",
    f"""select {sk("'S' || r_regionkey")} as site_sk, 'S' || r_regionkey as site_code, r_name as site_name, null as domain,
'GBP' as default_currency, 'UTC' as timezone, 'Asia/Bangkok' as reporting_timezone, r_regionkey <> 4 as is_active from region""",
)
def _(r):
    return r.wh.dim_site


@query(
    "m3_dim_country",
    "country_sk:s country_code:s country_name:s region:s currency:s",
    "select country_sk, code as country_code, country_name, region, currency from d_country",
)
def _(r):
    return r.model("dim_country")


@query(
    "m4_dim_payment_method",
    "payment_method_sk:s method_code:s method_name:s",
    f"""select {sk('m')} as payment_method_sk, m as method_code, n as method_name from
(select coalesce(payment_method, 'unknown') as m, max(payment_method_title) as n from stg_o group by 1)""",
)
def _(r):
    return r.model("dim_payment_method")


@query(
    "m5_dim_product",
    "product_sk:s site_sk:s site_code:s woo_product_id:i product_name:s product_url:s product_type:s sku:s "
    "first_seen_date:d last_seen_date:d",
    """select product_sk, site_sk, site_code, product_id as woo_product_id, name as product_name, url as product_url,
product_type, sku, first_seen as first_seen_date, last_seen as last_seen_date from d_product""",
)
def _(r):
    return r.model("dim_product")


@query(
    "m6_dim_customer_anonymized",
    "customer_sk:s customer_hash:s is_unknown_email:b country_sk:s first_order_date:d last_order_date:d",
    f"""select {sk('customer_hash')} as customer_sk, customer_hash, bool_and(is_unknown_email) as is_unknown_email,
{sk('arg_min(country_code, row(order_date, k))')} as country_sk, min(order_date) as first_order_date,
max(order_date) as last_order_date from stg_o group by customer_hash""",
)
def _(r):
    return r.model("dim_customer_anonymized")


# --- facts -------------------------------------------------------------------

F_ORDER_SQL = """select order_sk, site_sk, date_sk, customer_sk, country_sk, payment_method_sk, order_natural_key,
k as woo_order_id, status, status in ('cancelled', 'failed') as status_is_cancelled, ccy as currency_source,
fx_rate as fx_rate_to_usd, total as order_total_src, order_total_usd, shipping_src as shipping_charged_src,
shipping_usd as shipping_charged_usd, discount_src, discount_usd, tax_src, tax_usd, payment_fee_usd,
fee_source as payment_fee_source, fee_source = 'missing' as payment_fee_needs_review, 1 as order_count from f_order"""


@query(
    "m7_fact_order",
    "order_sk:s site_sk:s date_sk:i customer_sk:s country_sk:s payment_method_sk:s order_natural_key:s woo_order_id:i "
    "status:s status_is_cancelled:b currency_source:s fx_rate_to_usd:m order_total_src:m order_total_usd:m "
    "shipping_charged_src:m shipping_charged_usd:m discount_src:m discount_usd:m tax_src:m tax_usd:m payment_fee_usd:m "
    "payment_fee_source:s payment_fee_needs_review:b order_count:i",
    F_ORDER_SQL,
)
def _(r):
    return r.model("fact_order")


@query(
    "m8_fact_order_item",
    "order_item_sk:s order_sk:s site_sk:s date_sk:i product_sk:s country_sk:s customer_sk:s payment_method_sk:s "
    "woo_line_item_id:i woo_product_id:i quantity:i unit_price_src:m line_subtotal_src:m line_total_src:m "
    "fx_rate_to_usd:m line_revenue_usd:m order_status:s is_revenue_status:b size:s color:s style:s fit_type:s print_location:s",
    """select order_item_sk, order_sk, site_sk, date_sk, product_sk, country_sk, customer_sk, payment_method_sk,
item_id as woo_line_item_id, product_id as woo_product_id, quantity, unit_price as unit_price_src,
subtotal as line_subtotal_src, total as line_total_src, fx_rate as fx_rate_to_usd, line_revenue_usd,
status as order_status, is_revenue_status, size, color, style, fit_type, print_location from f_item""",
)
def _(r):
    return r.model("fact_order_item")


@query(
    "m9_fact_refund",
    "refund_sk:s order_sk:s site_sk:s country_sk:s customer_sk:s payment_method_sk:s order_item_sk:s date_sk:i "
    "woo_refund_id:i refund_amount_usd:m refund_reason:s event_type:s",
    """select refund_sk, order_sk, site_sk, country_sk, customer_sk, payment_method_sk, null as order_item_sk, date_sk,
refund_id as woo_refund_id, refund_usd as refund_amount_usd, reason as refund_reason, event_type from f_refund""",
)
def _(r):
    return r.model("fact_refund")


@query(
    "m10_fact_order_cost",
    "order_cost_sk:s order_sk:s site_sk:s date_sk:i country_sk:s customer_sk:s payment_method_sk:s cogs_usd:m "
    "design_fee_usd:m payment_fee_fallback_usd:m csv_shipping_charged_usd:m csv_revenue_observed_usd:m "
    "csv_profit_observed_usd:m cost_source:s cost_allocation_method:s cost_confidence:m",
    """select order_sk as order_cost_sk, order_sk, site_sk, date_sk, country_sk, customer_sk, payment_method_sk, cogs_usd,
design_fee_usd, fee_fallback_usd as payment_fee_fallback_usd, sheet_ship_usd as csv_shipping_charged_usd,
revenue_observed as csv_revenue_observed_usd, profit_observed as csv_profit_observed_usd, 'manual_csv' as cost_source,
'order_only' as cost_allocation_method, 1 as cost_confidence from f_cost""",
)
def _(r):
    return r.model("fact_order_cost")


# --- marts -------------------------------------------------------------------


@query(
    "m11_mart_order_profit",
    "order_sk:s site_sk:s date_sk:i gross_product_revenue_usd:m shipping_charged_usd:m gross_revenue_usd:m refunds_usd:m "
    "effective_refund_usd:m net_revenue_usd:m revenue_usd:m cogs_usd:m design_fee_usd:m payment_fee_usd:m "
    "contribution_profit_usd:m profit_margin:r cost_confidence:m cost_allocation_method:s payment_fee_source:s "
    "country_sk:s customer_sk:s payment_method_sk:s order_status:s",
    """select order_sk, site_sk, date_sk, gross_product_revenue_usd, shipping as shipping_charged_usd,
gross as gross_revenue_usd, refunds as refunds_usd, applied as effective_refund_usd, net as net_revenue_usd,
net as revenue_usd, cogs_usd, design_fee_usd, fee as payment_fee_usd, profit as contribution_profit_usd,
margin as profit_margin, 1 as cost_confidence, 'order_only' as cost_allocation_method, fee_source as payment_fee_source,
country_sk, customer_sk, payment_method_sk, status as order_status from m_order""",
)
def _(r):
    return r.model("mart_order_profit")


@query(
    "m12_mart_product_profit",
    "order_item_sk:s order_sk:s site_sk:s date_sk:i product_sk:s country_sk:s customer_sk:s payment_method_sk:s "
    "order_status:s woo_line_item_id:i woo_product_id:i quantity:i line_revenue_usd:m line_shipping_usd:m "
    "line_refund_usd:m line_net_revenue_usd:m line_cogs_usd:m line_design_fee_usd:m line_payment_fee_usd:m "
    "line_profit_usd:m cost_allocation_method:s cost_confidence:m is_revenue_status:b",
    """select order_item_sk, order_sk, site_sk, date_sk, product_sk, country_sk, customer_sk, payment_method_sk,
status as order_status, item_id as woo_line_item_id, product_id as woo_product_id, quantity, line_revenue_usd,
line_shipping as line_shipping_usd, line_refund as line_refund_usd, line_net as line_net_revenue_usd,
line_cogs as line_cogs_usd, line_design as line_design_fee_usd, line_fee as line_payment_fee_usd,
line_profit as line_profit_usd, 'allocated_by_revenue_share' as cost_allocation_method, 0.60 as cost_confidence,
is_revenue_status from m_line""",
)
def _(r):
    return r.model("mart_product_profit")


CUSTOMER_SPEC = (
    "customer_sk:s customer_hash:s first_order_date:d first_order_month:d last_order_date:d total_orders:i "
    "total_revenue_usd:m total_profit_usd:m is_repeat:b preferred_site_sk:s preferred_country_sk:s"
)
CUSTOMER_SQL = """select customer_sk, customer_hash, first_order_date, first_order_month, last_order_date, total_orders,
total_revenue as total_revenue_usd, total_profit as total_profit_usd, is_repeat, preferred_site_sk, preferred_country_sk"""


@query("m13_mart_customer_summary", CUSTOMER_SPEC, CUSTOMER_SQL + " from m_customer")
def _(r):
    return r.model("mart_customer_summary")


#: Few, for the tables of a test have few customers.
STATE_BUCKETS = 16


def order_values(r):
    return customer_orders(r.star.stg_orders, r.star.fact_order, r.star.fact_order_item, r.star.fact_refund, r.star.mart_order_profit)


@query("m13_customer_summary_in_batches", CUSTOMER_SPEC, CUSTOMER_SQL + " from m_customer")
def _(r):
    """The summary kept up by three batches, one of them repeated. The first counts every
    fifth order twice over and at no site; the last takes that back."""
    path, orders = r.folder("customers"), settle(order_values(r))
    k, batch = F.col("woo_order_id"), F.pmod(F.xxhash64("woo_order_id"), F.lit(3))
    wrong = orders.withColumns({"order_revenue_usd": (F.col("order_revenue_usd") * 2).cast("decimal(28,6)"), "site_code": F.lit(None).cast("string"), "country_code": F.lit("ZZ")})
    early = orders.filter((batch == 0) & (k % 5 != 0)).unionByName(wrong.filter((batch == 0) & (k % 5 == 0)))
    customers.update(early, path, 0, STATE_BUCKETS)
    for _ in range(2):
        customers.update(orders.filter(batch == 1), path, 1, STATE_BUCKETS)
    again = (batch == 0) & (k % 5 == 0)
    late = orders.filter(batch == 2).withColumn("weight", F.lit(1))
    customers.update(late.unionByName(customers.changes(wrong.filter(again), orders.filter(again))), path, 2, STATE_BUCKETS)
    return customers.summary(r.spark, path)


@query(
    "p14_customer_bands",
    CUSTOMER_SPEC + " days_since_last_order:i recency_segment:s clv_bucket:s segment:s",
    CUSTOMER_SQL + ", days_since as days_since_last_order, recency_segment, clv_bucket, segment from m_people",
)
def _(r):
    return customer_bands(r.star.mart_customer_summary)


# --- reconciliation ----------------------------------------------------------

def pct(part: str, whole: str) -> str:
    return f"cast({part} as double) / nullif({whole}, 0) * 100"


# Least percent of each label.
TIERS = [(95, "green"), (80, "yellow")]
_BEARING = pct("covered_revenue_orders_with_cogs", "revenue_orders")
_TIER = " ".join(f"when {_BEARING} >= {least} then '{label}'" for least, label in TIERS)

COVERAGE_SQL = f"""select *, round({pct('covered_orders', 'woo_orders')}, 2) as all_order_coverage_pct,
round({_BEARING}, 2) as cost_coverage_pct, round({_BEARING}, 2) as cogs_coverage_pct, case {_TIER} else 'red' end as coverage_tier
from (select case when grouping(f.site_sk) = 1 then '__ALL__' else f.site_sk end as site_sk, count(*) as woo_orders,
count(s.k) as revenue_orders, count(c.k) as covered_orders, count(c.k) filter (where s.k is not null) as covered_revenue_orders,
count(c.k) filter (where s.k is not null and c.cogs_usd > 0) as covered_revenue_orders_with_cogs
from f_order f left join rev_set s on s.k = f.k left join f_cost c on c.k = f.k group by rollup (f.site_sk))"""


@query(
    "m14_recon_cost_coverage",
    "site_sk:s woo_orders:i revenue_orders:i covered_orders:i covered_revenue_orders:i covered_revenue_orders_with_cogs:i "
    "all_order_coverage_pct:R cost_coverage_pct:R cogs_coverage_pct:R coverage_tier:s",
    COVERAGE_SQL,
)
def _(r):
    return recon.recon_cost_coverage(r.star.fact_order, r.star.fact_order_item, r.star.fact_order_cost)


FEE_COVERAGE_SPEC = (
    "payment_fee_source:s order_count:i orders_with_fee:i revenue_orders:i revenue_orders_with_fee:i "
    "all_order_coverage_pct:R fee_coverage_pct:R"
)
FEE_COVERAGE_SQL = """select *, round(100.0 * orders_with_fee / nullif(order_count, 0), 2) as all_order_coverage_pct,
round(100.0 * revenue_orders_with_fee / nullif(revenue_orders, 0), 2) as fee_coverage_pct
from (select case when grouping(fee_source) = 1 then '__ALL__' else fee_source end as payment_fee_source, count(*) as order_count,
count(payment_fee_usd) as orders_with_fee, count(s.k) as revenue_orders,
count(payment_fee_usd) filter (where s.k is not null) as revenue_orders_with_fee
from f_order f left join rev_set s on s.k = f.k group by grouping sets ((fee_source), ()))"""


@query("m15_recon_payment_fee_coverage", FEE_COVERAGE_SPEC, FEE_COVERAGE_SQL)
def _(r):
    return recon.recon_payment_fee_coverage(r.star.fact_order, r.star.fact_order_item)


@query(
    "m16_recon_csv_vs_dbt_profit",
    "order_sk:s csv_profit_observed_usd:m dbt_profit_usd:m delta_usd:m delta_pct:r",
    f"""select order_sk, profit_observed as csv_profit_observed_usd, profit as dbt_profit_usd,
profit_observed - profit as delta_usd, {ratio('profit_observed - profit', 'profit')} as delta_pct from m_order""",
)
def _(r):
    return recon.recon_csv_vs_dbt_profit(r.star.fact_order_cost, r.star.mart_order_profit)


@query(
    "m17_recon_csv_vs_dbt_revenue",
    "order_sk:s csv_revenue_observed_usd:m dbt_revenue_usd:m shipping_charged_usd:m dbt_gross_usd:m delta_usd:m "
    "delta_pct:r delta_vs_gross_usd:m",
    f"""select order_sk, revenue_observed as csv_revenue_observed_usd, rev as dbt_revenue_usd, ship as shipping_charged_usd,
rev + ship as dbt_gross_usd, revenue_observed - rev as delta_usd, {ratio('revenue_observed - rev', 'rev')} as delta_pct,
revenue_observed - rev - ship as delta_vs_gross_usd from
(select c.order_sk, c.revenue_observed, coalesce(p.product_usd, 0) as rev, coalesce(f.shipping_usd, 0) as ship
from f_cost c join f_order f on f.k = c.k left join per_order_rev p on p.k = c.k)""",
)
def _(r):
    return recon.recon_csv_vs_dbt_revenue(r.star.fact_order_cost, r.star.fact_order_item, r.star.fact_order)


@query(
    "m18_recon_shipping_charged",
    "site_sk:s date_sk:i woo_shipping_charged_usd:M csv_shipping_charged_usd:M delta_usd:M delta_pct:r",
    f"""select site_sk, date_sk, a as woo_shipping_charged_usd, b as csv_shipping_charged_usd, a - b as delta_usd,
{ratio('a - b', 'a')} as delta_pct from (select f.site_sk, f.date_sk, coalesce(sum(f.shipping_usd), 0) as a,
coalesce(sum(c.sheet_ship_usd), 0) as b from f_order f join f_cost c on c.k = f.k group by f.site_sk, f.date_sk)""",
)
def _(r):
    return recon.recon_shipping_charged(r.star.fact_order, r.star.fact_order_cost)


@query(
    "m19_recon_unmatched_csv_cost",
    "site_code:s order_code:i order_date:d currency:s cogs_usd:m design_fee_usd:m csv_revenue_observed_usd:m",
    """select site_code, k as order_code, order_date, ccy as currency, cogs_usd, design_fee_usd,
revenue_observed as csv_revenue_observed_usd from stg_c where k < 0""",
)
def _(r):
    return recon.recon_unmatched_csv_cost(r.wh.stg_cost, r.wh.stg_orders)


@query(
    "p10_unmatched_one_site",
    "site_code:s order_code:i cogs_usd:m",
    "select site_code, k as order_code, cogs_usd from stg_c where k < 0 and site_code = 'S1'",
)
def _(r):
    return recon.recon_unmatched_csv_cost(r.wh.stg_cost, r.wh.stg_orders, "S1")
