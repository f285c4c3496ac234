"""Joins, aggregates, windows, rankings and set operations (J, A, W, T, U rows)."""

from __future__ import annotations


from pyspark.sql import functions as F

from tallyhouse.functions.keys import country_or_none
from tallyhouse.functions.money import TOTAL
from tallyhouse.operators import aggregates as agg
from tallyhouse.operators import joins, setops, topk, windows
from tallyhouse.plans import marts, recon, reports
from tallyhouse.plans.facts import ORDER
from tallyhouse.plans.measures import evaluate, slice_by
from tallyhouse.queries import adapter
from tallyhouse.queries.oracle_tables import ratio, usd
from tallyhouse.queries.registry import query

# --- joins -------------------------------------------------------------------


@query(
    "j1_order_rate",
    "woo_order_id:i currency_source:s order_total_usd:m",
    "select k as woo_order_id, ccy as currency_source, order_total_usd from f_order",
)
def _(r):
    return joins.fx_convert(r.star.stg_orders, r.wh.fx, "currency_source", "order_date", {"order_total_usd": "order_total_src"})


@query(
    "j2_fee_currency_rate",
    "woo_order_id:i fee_usd:m",
    f"""select k as woo_order_id, case when stripe_fee is not null then {usd('stripe_fee', 'fx_rate')} else paypal_fee end as fee_usd from f_order""",
)
def _(r):
    return joins.fx_convert(
        r.star.stg_orders, r.wh.fx, "plugin_payment_fee_currency", "order_date", {"fee_usd": "plugin_payment_fee_src"}
    )


@query(
    "j3_fee_seed",
    "woo_order_id:i fee_percent:m fixed_fee_usd:m",
    """select k as woo_order_id, case payment_method when '1-URGENT' then 0.029 when '2-HIGH' then 0.019 end as fee_percent,
case payment_method when '1-URGENT' then 0.3 when '2-HIGH' then 0.2 end as fixed_fee_usd from stg_o""",
)
def _(r):
    return joins.with_fee_seed(r.star.stg_orders, r.wh.fees)


@query(
    "j4_line_header",
    "site_code:s woo_order_id:i status:s lines:i",
    "select 'S' || (l_orderkey % 5) as site_code, l_orderkey as woo_order_id, status, count(*) as lines from lineitem join base_order on k = l_orderkey group by all",
)
def _(r):
    lines = r.star.stg_order_items.groupBy(*ORDER).agg(F.count(F.lit(1)).alias("lines"))
    return joins.with_header(lines, r.star.stg_orders, ["status"])


@query(
    "j5_line_rate",
    "woo_order_id:i fx_rate_to_usd:m revenue:M",
    "select k as woo_order_id, fx_rate as fx_rate_to_usd, sum(line_revenue_usd) as revenue from f_item group by k, fx_rate",
)
def _(r):
    return r.model("fact_order_item").groupBy("woo_order_id", "fx_rate_to_usd").agg(F.sum("line_revenue_usd").alias("revenue"))


@query(
    "j6_inherited_keys",
    "refund_id:i country_sk:s customer_sk:s payment_method_sk:s",
    "select refund_id, country_sk, customer_sk, payment_method_sk from f_refund",
)
def _(r):
    refunds = r.wh.stg_refunds.select(*ORDER, F.col("woo_refund_id").alias("refund_id"))
    return joins.inherit_keys(refunds, r.model("fact_order"))


@query("j7_refund_date_rate", "woo_refund_id:i refund_amount_usd:m", "select refund_id as woo_refund_id, refund_usd as refund_amount_usd from f_refund")
def _(r):
    return r.model("fact_refund")


@query(
    "j8_cost_matched",
    "order_sk:s payment_fee_fallback_usd:m csv_shipping_charged_usd:m",
    "select order_sk, fee_fallback_usd as payment_fee_fallback_usd, sheet_ship_usd as csv_shipping_charged_usd from f_cost",
)
def _(r):
    return r.model("fact_order_cost")


@query("j9_unmatched_cost", "site_code:s woo_order_id:i", "select site_code, k as woo_order_id from stg_c where k < 0")
def _(r):
    return joins.unmatched(r.wh.stg_cost, r.star.stg_orders, ORDER)


@query(
    "j10_sold_but_not_catalogued",
    "site_code:s woo_product_id:i lines:i",
    "select site_code, product_id as woo_product_id, count(*) as lines from stg_i where product_id % 50 = 0 group by all",
)
def _(r):
    keys = ["site_code", "woo_product_id"]
    sold = r.star.stg_order_items.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"))
    return joins.unmatched(sold, r.wh.stg_products, keys)


@query("j11_enriched_countries", "country_code:s country_name:s", "select code as country_code, case when country_name = code or code = 'XX' then null else country_name end as country_name from d_country")
def _(r):
    named = r.wh.inputs.country_seed.groupBy("country_code").agg(F.max("country_name").alias("country_name"))
    ordered = r.star.stg_orders.select(country_or_none("billing_country_code").alias("country_code")).distinct()
    return joins.enrich(setops.union_distinct(ordered, named.select("country_code")), named, "country_code")


@query(
    "j12_first_country",
    "customer_hash:s country_code:s orders:i",
    "select customer_hash, arg_min(country_code, row(order_date, k)) as country_code, count(*) as orders from stg_o group by 1",
)
def _(r):
    first = F.struct("order_date", "woo_order_id")
    return r.star.stg_orders.groupBy("customer_hash").agg(
        F.min_by(country_or_none("billing_country_code"), first).alias("country_code"), F.count(F.lit(1)).alias("orders")
    )


@query(
    "j13_profit_sources",
    "woo_order_id:i product:m refunds:m cogs_usd:m",
    "select k as woo_order_id, gross_product_revenue_usd as product, refunds, cogs_usd from m_order",
)
def _(r):
    s = r.star
    sold = marts.order_revenue(s.fact_order_item, "product").filter(F.col("product") > 0)
    refunds = marts.order_refunds(s.fact_refund, "_refunds")
    joined = s.fact_order_cost.select(*ORDER, "cogs_usd").join(sold, ORDER).join(refunds, ORDER, "left")
    return joined.withColumn("refunds", F.coalesce("_refunds", F.lit(0)))


@query(
    "j14_lines_of_profit_orders",
    "site_code:s woo_order_id:i lines:i revenue:M profit:m",
    "select site_code, k as woo_order_id, count(*) as lines, sum(line_revenue_usd) as revenue, max(profit) as profit from f_item join (select k, profit from m_order) using (k) group by all",
)
def _(r):
    profit = r.star.mart_order_profit.select(*ORDER, F.col("contribution_profit_usd").alias("profit"))
    per_order = r.star.fact_order_item.groupBy(*ORDER).agg(F.count(F.lit(1)).alias("lines"), F.sum("line_revenue_usd").alias("revenue"))
    return per_order.join(profit, ORDER)


@query(
    "j15_customer_orders",
    "woo_order_id:i customer_hash:s order_revenue_usd:m order_profit_usd:m",
    "select k as woo_order_id, customer_hash, order_revenue as order_revenue_usd, order_profit as order_profit_usd from cust_order",
)
def _(r):
    s = r.star
    return marts.customer_orders(s.stg_orders, s.fact_order, s.fact_order_item, s.fact_refund, s.mart_order_profit)


@query(
    "j16_covered_orders",
    "site_code:s orders:i total:M",
    "select f.site_code, count(*) as orders, sum(order_total_usd) as total from f_order f where k in (select k from f_cost) group by 1",
)
def _(r):
    kept = joins.covered(r.star.fact_order, r.star.fact_order_cost, ORDER)
    return kept.groupBy("site_code").agg(F.count(F.lit(1)).alias("orders"), F.sum("order_total_usd").alias("total"))


@query(
    "j17_revenue_flag",
    "woo_order_id:i is_revenue:b",
    "select k as woo_order_id, k in (select k from rev_set) as is_revenue from f_order",
)
def _(r):
    return joins.flag_member(r.star.fact_order.select(*ORDER), recon.revenue_orders(r.star.fact_order_item), ORDER, "is_revenue")


@query(
    "j18_site_counts",
    "site_sk:s orders:i revenue_orders:i covered_orders:i",
    """select site_sk, count(*) as orders, count(*) filter (where k in (select k from rev_set)) as revenue_orders,
count(*) filter (where k in (select k from f_cost)) as covered_orders from f_order group by 1""",
)
def _(r):
    s = r.star
    one = F.count(F.lit(1))
    keyed = s.fact_order.select(*ORDER, "site_sk")
    revenue = joins.covered(keyed, recon.revenue_orders(s.fact_order_item), ORDER).groupBy("site_sk").agg(one.alias("revenue_orders"))
    cost = joins.covered(keyed, s.fact_order_cost, ORDER).groupBy("site_sk").agg(one.alias("covered_orders"))
    return keyed.groupBy("site_sk").agg(one.alias("orders")).join(revenue, "site_sk", "left").join(cost, "site_sk", "left")


@query(
    "j19_full_outer_days",
    "date_sk:i orders:i refunds:i",
    """select coalesce(a.date_sk, b.date_sk) as date_sk, a.n as orders, b.n as refunds
from (select date_sk, count(*) as n from f_order group by 1) a full join (select date_sk, count(*) as n from f_refund group by 1) b on a.date_sk = b.date_sk""",
)
def _(r):
    a = r.star.fact_order.groupBy("date_sk").agg(F.count(F.lit(1)).alias("orders"))
    b = r.star.fact_refund.groupBy("date_sk").agg(F.count(F.lit(1)).alias("refunds"))
    return joins.full_outer_on(a, b, ["date_sk"])


@query(
    "j20_observed_vs_computed",
    "orders:i observed:M computed:M",
    "select count(*) as orders, sum(profit_observed) as observed, sum(profit) as computed from m_order",
)
def _(r):
    both = recon.recon_csv_vs_dbt_profit(r.star.fact_order_cost, r.star.mart_order_profit)
    return both.agg(F.count(F.lit(1)).alias("orders"), F.sum("csv_profit_observed_usd").alias("observed"), F.sum("dbt_profit_usd").alias("computed"))


@query(
    "j21_sliced_by_dimensions",
    "country_name:s method_code:s site_name:s year:i orders:i",
    """select country_name, coalesce(payment_method, 'unknown') as method_code, r_name as site_name, year(order_date) as year, count(*) as orders
from f_order join d_country using (country_sk) join region on 'S' || r_regionkey = site_code group by all""",
)
def _(r):
    by = ["country_name", "method_code", "site_name", "year"]
    keyed = r.star.fact_order.groupBy("country_sk", "payment_method_sk", "site_sk", "date_sk").agg(F.count(F.lit(1)).alias("n"))
    return slice_by(r.star, keyed, by).groupBy(*by).agg(F.sum("n").alias("orders"))


@query(
    "j22_between_dates",
    "site_code:s orders:i",
    "select site_code, count(*) as orders from base_order where order_date between date '1997-03-10' and date '1998-06-20' group by 1",
)
def _(r):
    return joins.between_dates(r.star.fact_order, 19970310, 19980620).groupBy("site_code").agg(F.count(F.lit(1)).alias("orders"))


@query("j23_orphan_keys", "fk:s", "select cast(k as varchar) as fk from stg_c where k < 0")
def _(r):
    """Sheet order ids without an order, found through distinct ids."""
    from tallyhouse.operators.checks import check_relationship

    return check_relationship(r.wh.stg_cost, "woo_order_id", r.star.stg_orders, "woo_order_id")


# --- aggregates --------------------------------------------------------------


@query(
    "a1_filtered_sum",
    "site_sk:s revenue:M other:M",
    "select site_sk, sum(line_revenue_usd) filter (where is_revenue_status) as revenue, sum(line_revenue_usd) filter (where not is_revenue_status) as other from f_item group by 1",
)
def _(r):
    flag = F.col("is_revenue_status")
    return r.star.fact_order_item.groupBy("site_sk").agg(
        agg.sum_where("line_revenue_usd", flag).alias("revenue"), agg.sum_where("line_revenue_usd", ~flag).alias("other")
    )


@query(
    "a2_first_row_per_key",
    "user_id:i event_type:s event_id:i",
    "select user_id, arg_min(event_type, event_id) as event_type, min(event_id) as event_id from events group by 1",
)
def _(r):
    rows = r.table("events").select("user_id", "event_type", "event_id")
    return agg.first_per_key(rows, ["user_id"], F.col("event_id"))


@query("a3_sum_per_order", "site_code:s woo_order_id:i refunds:m", "select site_code, k as woo_order_id, sum(refund_usd) as refunds from f_refund group by all")
def _(r):
    return agg.per_order(r.star.fact_refund, "refund_amount_usd", "refunds")


@query(
    "a4_distinct_counts",
    "site_sk:s orders:i big_orders:i",
    "select site_sk, count(distinct order_sk) as orders, count(distinct order_sk) filter (where quantity > 40) as big_orders from f_item group by 1",
)
def _(r):
    return r.star.fact_order_item.groupBy("site_sk").agg(
        F.count_distinct("order_sk").alias("orders"), agg.distinct_where("order_sk", F.col("quantity") > 40).alias("big_orders")
    )


@query(
    "a5_bool_and",
    "customer_hash:s all_unknown:b",
    "select customer_hash, bool_and(is_unknown_email) as all_unknown from stg_o group by 1",
)
def _(r):
    return r.star.stg_orders.groupBy("customer_hash").agg(F.bool_and("is_unknown_email").alias("all_unknown"))


@query(
    "a6_first_last_dates",
    "customer_hash:s first_day:d last_day:d",
    "select customer_hash, min(order_date) as first_day, max(order_date) as last_day from stg_o group by 1",
)
def _(r):
    return r.star.stg_orders.groupBy("customer_hash").agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))


@query("a7_mode", "customer_hash:s country_code:s", "select customer_hash, country_code from cust_country")
def _(r):
    return r.star.stg_orders.groupBy("customer_hash").agg(
        F.mode(country_or_none("billing_country_code"), True).alias("country_code")
    )


@query(
    "a8_first_country_nulls_last",
    "customer_hash:s country_code:s",
    """select customer_hash, arg_min(country_code, row(case when k % 3 = 0 then 1 else 0 end, order_date, k)) as country_code from stg_o group by 1""",
)
def _(r):
    """Every third order's date is taken away: such orders come last."""
    rows = r.star.stg_orders.select(
        "customer_hash", country_or_none("billing_country_code").alias("country_code"), "woo_order_id",
        F.when(F.col("woo_order_id") % 3 != 0, F.col("order_date")).alias("day"),
        F.col("order_date").alias("known"),
    )
    order = F.struct(*agg.nulls_last("day"), F.col("known"), F.col("woo_order_id"))
    return agg.first_per_key(rows, ["customer_hash"], order)


@query("a9_distinct_keys", "woo_order_id:i", "select k as woo_order_id from rev_set")
def _(r):
    return recon.revenue_orders(r.star.fact_order_item)


@query(
    "a10_grouping_sets",
    "payment_fee_source:s orders:i fees:M",
    "select case when grouping(fee_source) = 1 then '__ALL__' else fee_source end as payment_fee_source, count(*) as orders, sum(payment_fee_usd) as fees from f_order group by grouping sets ((fee_source), ())",
)
def _(r):
    return agg.with_total(r.star.fact_order, "payment_fee_source", [F.count(F.lit(1)).alias("orders"), F.sum("payment_fee_usd").alias("fees")])


@query(
    "a11_per_site_and_all",
    "site_sk:s orders:i",
    "select coalesce(site_sk, '__ALL__') as site_sk, count(*) as orders from f_order group by rollup (site_sk)",
)
def _(r):
    per_site = r.star.fact_order.groupBy("site_sk").agg(F.count(F.lit(1)).alias("orders"))
    return agg.per_site_and_all(per_site, "site_sk", ["orders"])


@query(
    "a12_coverage_percent",
    "site_sk:s fee_pct:R paid_fee_pct:R",
    """select site_sk, round(100.0 * count(payment_fee_usd) / count(*), 2) as fee_pct,
round(100.0 * count(payment_fee_usd) filter (where status = 'completed') / nullif(count(*) filter (where status = 'completed'), 0), 2) as paid_fee_pct
from f_order group by 1""",
)
def _(r):
    done = F.col("status") == "completed"
    has_fee = F.col("payment_fee_usd").isNotNull()
    counts = r.star.fact_order.groupBy("site_sk").agg(
        F.count("payment_fee_usd").alias("a"), F.count(F.lit(1)).alias("b"), F.count_if(done & has_fee).alias("c"), F.count_if(done).alias("d")
    )
    return counts.select("site_sk", agg.coverage("a", "b").alias("fee_pct"), agg.coverage("c", "d").alias("paid_fee_pct"))


@query(
    "a13_any_label",
    "payment_method:s title:s",
    "select payment_method, max(payment_method_title) as title from stg_o group by 1",
)
def _(r):
    return r.star.stg_orders.groupBy("payment_method").agg(F.max("payment_method_title").alias("title"))


@query(
    "a14_total_coverage",
    "covered:i revenue_orders:i pct:R",
    """select count(*) filter (where cogs_usd > 0) as covered, count(*) as revenue_orders, round(100.0 * count(*) filter (where cogs_usd > 0) / count(*), 2) as pct
from rev_set left join (select k, cogs_usd from f_cost) using (k)""",
)
def _(r):
    orders = recon.revenue_orders(r.star.fact_order_item)
    cost = r.star.fact_order_cost.select(*ORDER, "cogs_usd")
    counts = orders.join(cost, ORDER, "left").agg(F.count_if(F.col("cogs_usd") > 0).alias("covered"), F.count(F.lit(1)).alias("revenue_orders"))
    return counts.withColumn("pct", agg.coverage("covered", "revenue_orders"))


@query(
    "a15_group_median",
    "median_quantity:r",
    "select median(q) as median_quantity from (select l_partkey, sum(l_quantity) as q from lineitem group by 1 having sum(l_quantity) > 100)",
)
def _(r):
    q = F.sum("l_quantity")
    return agg.group_median(r.table("lineitem"), "l_partkey", q, q > 100, "median_quantity")


@query(
    "a16_count_groups",
    "heavy_orders:i",
    "select count(*) as heavy_orders from (select l_orderkey from lineitem group by 1 having sum(l_quantity) > 150)",
)
def _(r):
    return agg.count_groups(r.table("lineitem"), "l_orderkey", F.sum("l_quantity") > 150, "heavy_orders")


@query(
    "a17_repeat_share",
    "site_code:s share:r",
    """select site_code, count(*) filter (where n >= 2) / count(*)::double as share from
(select site_code, o_custkey, count(*) as n from base_order group by all) group by 1""",
)
def _(r):
    o = adapter.base_orders(r.table("orders"))
    return agg.repeat_share(o, "o_custkey", ["site_code"], 2, "share")


@query(
    "a18_days_since_latest",
    "customer_hash:s days:i",
    "select customer_hash, days_since as days from m_customer",
)
def _(r):
    return agg.days_since_latest(r.star.mart_customer_summary, "last_order_date", "days")


@query("a19_order_count_histogram", "total_orders:i customers:i", "select total_orders, count(*) as customers from m_customer group by 1")
def _(r):
    return agg.histogram(r.star.mart_customer_summary, "total_orders", "customers")


@query("a20_acquisition", "first_order_month:d new_customers:i", "select first_order_month, count(*) as new_customers from m_customer group by 1")
def _(r):
    return agg.acquisition(r.star.mart_customer_summary)


# --- windows -----------------------------------------------------------------


@query(
    "w1_forward_fill",
    "event_id:i user_id:i filled:m",
    """select event_id, user_id, last_value(case when event_type = 'click' then cast(value as decimal(18,2)) end ignore nulls)
over (partition by user_id order by event_id rows unbounded preceding) as filled from events""",
)
def _(r):
    seen = F.when(F.col("event_type") == "click", F.col("value").cast("decimal(18,2)"))
    rows = r.table("events").select("event_id", "user_id", seen.alias("filled"))
    return windows.ffill(rows, ["user_id"], "event_id", ["filled"], block_bits=10)


@query(
    "w2_daily_fx",
    "currency:s order_date:d usd_rate:m orders:i",
    """select o.ccy as currency, order_date, rate as usd_rate, count(*) as orders from base_order o
left join fx_quote q on q.ccy = o.ccy and q.month = date_trunc('month', order_date) group by all""",
)
def _(r):
    """The filled daily rate of every currency and day that has orders."""
    days = r.star.stg_orders.groupBy(F.col("currency_source").alias("currency"), "order_date").agg(F.count(F.lit(1)).alias("orders"))
    until = adapter.last_day(r.table)
    rate = windows.daily_fx(adapter.fx_quotes(r.spark, until), F.lit(until).cast("date")).withColumnRenamed("rate_date", "order_date")
    return days.join(rate, ["currency", "order_date"], "left")


@query(
    "w3_share_of_order",
    "order_item_sk:s share:r",
    f"select order_item_sk, {ratio('line_revenue_usd', 'sum(line_revenue_usd) over (partition by k)')} as share from f_item",
)
def _(r):
    lines = r.star.fact_order_item.select(*ORDER, "order_item_sk", "line_revenue_usd")
    return windows.share_of(lines, "line_revenue_usd", ORDER, "share")


PARETO_SQL = f"""select product_name, revenue, sum(revenue) over (order by revenue desc range unbounded preceding) as cumulative_revenue,
{ratio('sum(revenue) over (order by revenue desc range unbounded preceding)', 'sum(revenue) over ()')} as cumulative_share from prod_rev"""


@query("w4_running_total", "product_name:s revenue:M cumulative_revenue:M", PARETO_SQL)
def _(r):
    return windows.running_total(reports.product_revenue(r.star), "revenue", "cumulative_revenue")


@query(
    "w5_running_share",
    "p_partkey:i cumulative_share:r",
    f"""select l_partkey as p_partkey, {ratio('sum(x) over (order by x desc range unbounded preceding)', 'sum(x) over ()')} as cumulative_share
from (select l_partkey, sum(cast(l_extendedprice as decimal(18,2))) as x from lineitem group by 1)""",
)
def _(r):
    """Running share over every part: many thousand levels."""
    parts = r.table("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast(TOTAL).alias("x")
    )
    return windows.running_total(parts, "x", "cum", "cumulative_share")


@query(
    "w6_share_of_total",
    "site_sk:s share:r",
    f"select site_sk, {ratio('sum(order_total_usd)', '(select sum(order_total_usd) from f_order)')} as share from f_order group by 1",
)
def _(r):
    per_site = r.star.fact_order.groupBy("site_sk").agg(F.sum("order_total_usd").alias("x"))
    return windows.share_of(per_site, "x", [], "share")


# --- rankings ----------------------------------------------------------------
CURVE_SQL = f"""select p as percent, {ratio('max(cum)', 'max(total)')} as cum_share from range(1, 101) t(p) join
(select revenue, rank() over (order by revenue desc) as rk, sum(revenue) over (order by revenue desc range unbounded preceding) as cum,
sum(revenue) over () as total, count(*) over () as n from prod_rev) on rk <= (n * p + 99) // 100 group by p"""


@query("t1k_top_percent", "percent:i cum_share:r", CURVE_SQL)
def _(r):
    return topk.top_percent(reports.product_revenue(r.star), "revenue")


@query(
    "t2k_percent_to_reach",
    "pct_at_50:i pct_at_80:i",
    f"select min(percent) filter (where cum_share >= 0.5) as pct_at_50, min(percent) filter (where cum_share >= 0.8) as pct_at_80 from ({CURVE_SQL})",
)
def _(r):
    return topk.percent_to_reach(reports.product_revenue(r.star), "revenue", {"pct_at_50": 0.5, "pct_at_80": 0.8})


@query("t3k_top_name", "top_market_name:s", "select max(country_name) as top_market_name from country_rev where revenue = (select max(revenue) from country_rev)")
def _(r):
    return reports.top_market(r.star)


@query(
    "t4k_best_margin_with_floor",
    "best_margin_major_market:s",
    f"""select arg_max(country_name, row(m, country_name)) as best_margin_major_market from country_rev join
(select country_name, {ratio('sum(profit)', 'sum(net)')} as m from m_order join d_country using (country_sk) group by 1) using (country_name)
where revenue >= 2000""",
)
def _(r):
    return reports.best_margin_market(r.star)


@query(
    "t5k_top_n",
    "country_name:s revenue:M",
    "select country_name, revenue from country_rev where revenue >= (select min(revenue) from (select revenue from country_rev order by revenue desc limit 8))",
)
def _(r):
    return topk.top_n(evaluate(r.star, ["revenue"], ["country_name"]), "revenue", 8)


@query(
    "t6k_ordinal_sort",
    "month:i month_name:s orders:i",
    "select month(order_date) as month, strftime(order_date, '%b') as month_name, count(*) as orders from base_order group by all",
)
def _(r):
    return topk.order_by_ordinal(evaluate(r.star, ["order_attempts"], ["month", "month_name"]).withColumnRenamed("order_attempts", "orders"), "month")


# --- set operations ----------------------------------------------------------


@query("u1_union_distinct", "code:s", "select code from d_country")
def _(r):
    a = r.star.stg_orders.select(country_or_none("billing_country_code").alias("code"))
    return setops.union_distinct(a, r.wh.inputs.country_seed.select(F.col("country_code").alias("code")))


@query(
    "u2_union_named",
    "order_key:i total:m refund:m",
    "select k as order_key, total, null as refund from base_order union all select k, null, refund_usd from f_refund",
)
def _(r):
    a = r.star.stg_orders.select(F.col("woo_order_id").alias("order_key"), F.col("order_total_src").alias("total"))
    b = r.star.fact_refund.select(F.col("woo_order_id").alias("order_key"), F.col("refund_amount_usd").alias("refund"))
    return setops.union_named(a, b)


@query(
    "u3_union_totals",
    "status:s orders:i",
    "select coalesce(status, '__ALL__') as status, count(*) as orders from base_order group by rollup (status)",
)
def _(r):
    per = r.star.fact_order.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))
    return agg.per_site_and_all(per, "status", ["orders"])


@query(
    "u4_set_difference",
    "site_code:s issue:s",
    "select 'S9' as site_code, 'missing_from_seed' as issue union all select distinct site_code, 'unexpected_in_seed' from base_order where site_code = 'S0'",
)
def _(r):
    """Sites met in the orders against a list that lacks one and has one too many."""
    met = adapter.base_orders(r.table("orders")).select("site_code").distinct()
    listed = met.filter("site_code <> 'S0'").unionByName(r.spark.range(1).select(F.lit("S9").alias("site_code")))
    return setops.set_diff(listed, met, "site_code")
