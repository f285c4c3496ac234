"""The measure layer (Q rows and report cuts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.plans import distinct, reports
from tallyhouse.plans.measures import evaluate
from tallyhouse.queries.operating import CURVE_SQL, PARETO_SQL
from tallyhouse.queries.oracle_tables import REVENUE, ratio
from tallyhouse.queries.registry import query
from tallyhouse.session import settle

# Aggregates per fact in SQL, under the names of the measure parts.
LINE = "filter (where is_revenue_status)"
FACTS = {
    "f_item": {
        "revenue": f"sum(line_revenue_usd) {LINE}",
        "quantity_sold": f"sum(quantity) {LINE}",
        "distinct_products_sold": f"nullif(count(distinct product_sk) {LINE}, 0)",
    },
    "f_refund": {"refund_amount": "sum(refund_usd)", "refunded_orders": "nullif(count(distinct order_sk), 0)"},
    "m_order": {
        "paid_orders": "count(distinct order_sk)",
        "cogs": "sum(cogs_usd)",
        "payment_fee": "sum(fee)",
        "design_fee": "sum(design_fee_usd)",
        "profit_base_net_revenue": "sum(net)",
        "contribution_profit": "sum(profit)",
    },
    "f_order": {
        "shipping_charged": "sum(shipping_usd)",
        "order_attempts": "count(*)",
        "completed_orders": "nullif(count(*) filter (where status = 'completed'), 0)",
        "failed_orders": "nullif(count(*) filter (where status = 'failed'), 0)",
        "cancelled_orders": "nullif(count(*) filter (where status = 'cancelled'), 0)",
        "open_backlog": "nullif(count(*) filter (where status = 'processing'), 0)",
        "method_paid_orders": f"nullif(count(*) filter (where status in {REVENUE}), 0)",
        "order_fee": "sum(payment_fee_usd)",
        "order_total": "sum(order_total_usd)",
        "paid_total": f"sum(order_total_usd) filter (where status in {REVENUE})",
        "markets_served": "count(distinct country_sk)",
    },
    "m_line": {"product_profit": "sum(line_profit)", "product_net_revenue": "sum(line_net)"},
    "m_people": {
        "distinct_customers": "count(*)",
        "repeat_customers": "nullif(count(*) filter (where is_repeat), 0)",
        "customer_orders": "sum(total_orders)",
        "seg_lifetime_revenue": "sum(total_revenue)",
        "lapsed_customers": "nullif(count(*) filter (where recency_segment = 'Lapsed 12+mo'), 0)",
    },
}
COST = "(coalesce(cogs, 0) + coalesce(design_fee, 0) + coalesce(payment_fee, 0))"
RATIOS = {
    "net_revenue": "coalesce(revenue, 0) - coalesce(refund_amount, 0)",
    "total_cost": COST,
    "aov": ratio("revenue", "paid_orders"),
    "avg_units_per_order": ratio("quantity_sold", "paid_orders"),
    "profit_margin": ratio("contribution_profit", "profit_base_net_revenue"),
    "cost_ratio": ratio(COST, "profit_base_net_revenue"),
    "cogs_ratio": ratio("cogs", "profit_base_net_revenue"),
    "cost_per_order": ratio(COST, "paid_orders"),
    "cost_per_unit": ratio(COST, "quantity_sold"),
    "cogs_per_unit": ratio("cogs", "quantity_sold"),
    "product_margin": ratio("product_profit", "product_net_revenue"),
    "paid_success_rate": ratio("paid_orders", "order_attempts"),
    "failed_rate": ratio("failed_orders", "order_attempts"),
    "cancellation_rate": ratio("cancelled_orders", "order_attempts"),
    "refund_rate": ratio("refunded_orders", "paid_orders"),
    "payment_fee_rate": ratio("order_fee", "order_total"),
    "method_approval_rate": ratio("method_paid_orders", "order_attempts"),
    "method_lost": "order_attempts - coalesce(method_paid_orders, 0)",
    "method_fee_rate": ratio("payment_fee", "paid_total"),
    "orders_per_customer": ratio("customer_orders", "distinct_customers"),
    "repeat_rate": ratio("repeat_customers", "distinct_customers"),
    "one_time_share": f"1 - coalesce({ratio('repeat_customers', 'distinct_customers')}, 0)",
    "lapsed_share": ratio("lapsed_customers", "distinct_customers"),
    "new_customers": "distinct_customers",
    "seg_ltv": ratio("seg_lifetime_revenue", "distinct_customers"),
    "seg_revenue_per_order": ratio("seg_lifetime_revenue", "customer_orders"),
}
METHODS = "join (select distinct payment_method_sk as pm, coalesce(payment_method, 'unknown') as method_code from f_order) on pm = payment_method_sk"
# group-by attribute -> (join, expression)
CUTS = {
    "country_name": ("join d_country using (country_sk)", "country_name"),
    "method_code": (METHODS, "method_code"),
    "year": ("", "date_sk // 10000"),
    "month": ("", "date_sk // 100 % 100"),
    "site_code": ("", "site_code"),
    "product_name": ("join (select product_sk, name as product_name from d_product) using (product_sk)", "product_name"),
    "segment": ("", "segment"),
    "clv_bucket": ("", "clv_bucket"),
    "recency_segment": ("", "recency_segment"),
    "first_order_month": ("", "first_order_month"),
    "status": ("", "status"),
}


def cut_sql(facts: list[str], by: list[str]) -> str:
    """Parts of the facts per group, stacked and folded, then every ratio they allow."""
    pieces = []
    for f in facts:
        joins = " ".join(CUTS[b][0] for b in by)
        keys = ", ".join(f"{CUTS[b][1]} as {b}" for b in by)
        parts = ", ".join(f"{sql} as {n}" for n, sql in FACTS[f].items())
        group = " group by all" if by else ""
        pieces.append(f"select {keys + ', ' if keys else ''}{parts} from {f} {joins}{group}")
    names = [n for f in facts for n in FACTS[f]]
    folded = f"select {', '.join([*by, *[f'max({n}) as {n}' for n in names]])} from ({' union all by name '.join(pieces)}){' group by all' if by else ''}"
    known = [f"{sql} as {n}" for n, sql in RATIOS.items() if not (_inputs(sql) - set(names))]
    return f"select *{''.join(', ' + k for k in known)} from ({folded})"


def _inputs(sql: str) -> set[str]:
    every = {n for parts in FACTS.values() for n in parts}
    import re

    return {w for w in re.findall(r"\b[a-z_]+\b", sql) if w in every}


def measure_query(name: str, spec: str, facts: list[str], by: list[str]) -> None:
    """A query that evaluates the measures of its column list by its leading keys."""
    columns = [item.split(":")[0] for item in spec.split()]
    query(name, spec, cut_sql(facts, by))(lambda r: evaluate(r.star, columns[len(by):], by))


measure_query("q1_sales_by_month", "year:i month:i revenue:M quantity_sold:i distinct_products_sold:i", ["f_item"], ["year", "month"])
measure_query("q2_refunds_by_country", "country_name:s refund_amount:M refunded_orders:i net_revenue:M", ["f_item", "f_refund"], ["country_name"])
measure_query("q3_order_value_by_country", "country_name:s paid_orders:i aov:R avg_units_per_order:R", ["f_item", "m_order"], ["country_name"])
measure_query("q4_costs_by_method", "method_code:s cogs:M payment_fee:M design_fee:M total_cost:M", ["m_order"], ["method_code"])
measure_query("q5_profit_by_country", "country_name:s profit_base_net_revenue:M contribution_profit:M profit_margin:r", ["m_order"], ["country_name"])
measure_query("q6_cost_ratios_by_year", "year:i cost_ratio:r cogs_ratio:r cost_per_order:R cost_per_unit:R cogs_per_unit:R", ["m_order", "f_item"], ["year"])
measure_query("q7_shipping_by_site", "site_code:s shipping_charged:M", ["f_order"], ["site_code"])
measure_query("q8_product_profit", "product_name:s product_profit:M product_net_revenue:M product_margin:r", ["m_line"], ["product_name"])
measure_query("q9_orders_by_month", "year:i month:i order_attempts:i completed_orders:i failed_orders:i cancelled_orders:i open_backlog:i", ["f_order"], ["year", "month"])
measure_query("q9_orders_by_status_and_month", "status:s year:i month:i order_attempts:i", ["f_order"], ["status", "year", "month"])
measure_query("q10_rates_by_country", "country_name:s paid_success_rate:r failed_rate:r cancellation_rate:r refund_rate:r", ["m_order", "f_order", "f_refund"], ["country_name"])
measure_query("q11_fee_rate_by_method", "method_code:s payment_fee_rate:r", ["f_order"], ["method_code"])
measure_query("q12_method_quality", "method_code:s method_paid_orders:i method_approval_rate:r method_lost:i method_fee_rate:r", ["f_order", "m_order"], ["method_code"])
measure_query("q13_customer_base", "distinct_customers:i repeat_customers:i repeat_rate:r one_time_share:r orders_per_customer:r new_customers:i", ["m_people"], [])
measure_query("q13_new_customers_by_month", "first_order_month:d new_customers:i", ["m_people"], ["first_order_month"])
measure_query("q14_lapsed_share", "lapsed_share:r", ["m_people"], [])
measure_query("q15_segments", "segment:s seg_lifetime_revenue:M seg_ltv:R seg_revenue_per_order:R", ["m_people"], ["segment"])
measure_query("q15_value_buckets", "clv_bucket:s distinct_customers:i seg_lifetime_revenue:M", ["m_people"], ["clv_bucket"])
measure_query("q15_recency", "recency_segment:s distinct_customers:i", ["m_people"], ["recency_segment"])
measure_query("q17_markets_by_year", "year:i markets_served:i", ["f_order"], ["year"])


@query("q16_revenue_share", "country_name:s revenue:M revenue_share:r", f"select country_name, revenue, {ratio('revenue', 'sum(revenue) over ()')} as revenue_share from country_rev")
def _(r):
    return reports.revenue_share(r.star)


@query(
    "q16_international_share",
    "international_share:r",
    f"select 1 - {ratio('sum(revenue) filter (where country_name = ' + repr('Nation 1') + ')', 'sum(revenue)')} as international_share from country_rev",
)
def _(r):
    return reports.international_share(r.star, "Nation 1")


@query(
    "q17_country_repeat",
    "country_name:s country_repeat_rate:r",
    f"""select country_name, count(*) filter (where n >= 2) / count(*)::double as country_repeat_rate from
(select country_name, customer_sk, count(*) as n from f_order join d_country using (country_sk) where status in {REVENUE} group by all) group by 1""",
)
def _(r):
    return reports.country_repeat(r.star)


@query("q18_pareto", "product_name:s revenue:M cumulative_revenue:M cumulative_share:r", PARETO_SQL)
def _(r):
    return reports.pareto(r.star)


@query("q18_pareto_curve", "percent:i cum_share:r", CURVE_SQL)
def _(r):
    return reports.pareto_curve(r.star)


@query(
    "q18_pareto_points",
    "pct_at_50:i pct_at_80:i",
    f"select min(percent) filter (where cum_share >= 0.5) as pct_at_50, min(percent) filter (where cum_share >= 0.8) as pct_at_80 from ({CURVE_SQL})",
)
def _(r):
    return reports.pareto_points(r.star)


MEDIAN_SQL = f"select median({ratio('profit', 'net')}) from prod_line where net > 100"


@query("q19_median_margin", "median_margin:r", f"select ({MEDIAN_SQL}) as median_margin")
def _(r):
    return reports.median_margin(r.star)


@query(
    "q19_margin_vs_median",
    "product_name:s product_margin:r points_vs_median:r",
    f"select product_name, {ratio('profit', 'net')} as product_margin, ({ratio('profit', 'net')} - ({MEDIAN_SQL})) * 100 as points_vs_median from prod_line where net <> 0",
)
def _(r):
    return reports.margin_vs_median(r.star)


@query("q19_loss_making", "loss_making_designs:i", "select count(*) as loss_making_designs from prod_line where profit < 0")
def _(r):
    return reports.loss_making(r.star)


@query(
    "q20_top_markets",
    "top_market_name:s best_margin_major_market:s",
    f"""select (select arg_max(country_name, row(revenue, country_name)) from country_rev) as top_market_name,
(select arg_max(country_name, row(m, country_name)) from country_rev join (select country_name, {ratio('sum(profit)', 'sum(net)')} as m
from m_order join d_country using (country_sk) group by 1) using (country_name) where revenue >= 2000) as best_margin_major_market""",
)
def _(r):
    return reports.top_market(r.star).withColumn("best_margin_major_market", reports.best_margin_market(r.star).scalar())


BRIDGE_BASE = "select date_sk // 10000 as year, cast(sum(net) as decimal(28,6)) as n, cast(sum(cogs_usd) as decimal(28,6)) as c, cast(sum(design_fee_usd) as decimal(28,6)) as d, cast(sum(fee) as decimal(28,6)) as f, cast(sum(profit) as decimal(28,6)) as p from m_order group by 1"


@query(
    "q21_profit_bridge",
    "year:i step:s step_order:i bridge_value:M",
    f"""select year, s.step, s.o as step_order, case s.o when 1 then n when 2 then -c when 3 then -d when 4 then -f else p end as bridge_value
from ({BRIDGE_BASE}), (values ('Net rev', 1), ('COGS', 2), ('Design', 3), ('Payment fee', 4), ('Profit', 5)) s(step, o)""",
)
def _(r):
    return reports.bridge(r.star, ["year"])


@query(
    "q22_cost_structure",
    "year:i cost_type:s step_order:i cost_value:M cost_share:r",
    f"""select year, s.t as cost_type, s.o as step_order, case s.o when 1 then c when 2 then f when 3 then d else c + f + d end as cost_value,
{ratio('case s.o when 1 then c when 2 then f when 3 then d else c + f + d end', 'n')} as cost_share
from ({BRIDGE_BASE}), (values ('COGS', 1), ('Payment fee', 2), ('Design fee', 3), ('Total', 4)) s(t, o)""",
)
def _(r):
    return reports.cost_structure(r.star, ["year"])


MONTHLY = cut_sql(["f_item", "m_order"], ["year", "month"])


@query(
    "q23_trend_metrics",
    "year:i month:i metric:s step_order:i metric_value:R",
    f"""select year, month, s.t as metric, s.o as step_order, case s.o when 1 then profit_base_net_revenue::double when 2 then contribution_profit::double
when 3 then paid_orders::double else aov end as metric_value
from ({MONTHLY}), (values ('Revenue', 1), ('Profit', 2), ('Orders', 3), ('AOV', 4)) s(t, o)""",
)
def _(r):
    return reports.metric_rows(r.star, reports.TREND_METRICS, ["year", "month"])


@query(
    "q23_tooltip_metrics",
    "year:i month:i metric:s step_order:i metric_value:R",
    f"""select year, month, s.t as metric, s.o as step_order, case s.o when 1 then revenue::double when 2 then contribution_profit::double
when 3 then profit_margin else paid_orders::double end as metric_value
from ({MONTHLY}), (values ('Revenue', 1), ('Profit', 2), ('Margin', 3), ('Paid orders', 4)) s(t, o)""",
)
def _(r):
    return reports.metric_rows(r.star, reports.TOOLTIP_METRICS, ["year", "month"])


@query(
    "q24_last_8_months",
    "month_start:d revenue:M",
    """select m as month_start, coalesce(sum(line_revenue_usd) filter (where is_revenue_status), 0) as revenue from
(select cast(unnest(generate_series(date_trunc('month', a) - interval 7 month, date_trunc('month', a), interval 1 month)) as date) as m
from (select max(order_date)::timestamp as a from base_order))
left join (select *, date_trunc('month', strptime(date_sk::varchar, '%Y%m%d'))::date as im from f_item) on im = m group by 1""",
)
def _(r):
    return reports.last_months(r.star)


@query(
    "q24_growth_12_months",
    "current_value:M previous_value:M delta:r",
    f"""select c as current_value, p as previous_value, {ratio('c - p', 'p')} as delta from (
select sum(line_revenue_usd) filter (where d > a - interval 12 month and d <= a) as c,
sum(line_revenue_usd) filter (where d > a - interval 24 month and d <= a - interval 12 month) as p
from (select line_revenue_usd, strptime(date_sk::varchar, '%Y%m%d') as d,
(select max(order_date)::timestamp from base_order) as a from f_item where is_revenue_status))""",
)
def _(r):
    return reports.growth_12_months(r.star)


@query(
    "q25_calendar_drill",
    "year:i quarter:i month:i level:i revenue:M order_attempts:i",
    """select y as year, q as quarter, m as month, 3 - (grouping(y) + grouping(q) + grouping(m)) as level, sum(rev) as revenue, sum(n) as order_attempts
from (select date_sk // 10000 as y, (date_sk // 100 % 100 + 2) // 3 as q, date_sk // 100 % 100 as m, sum(line_revenue_usd) filter (where is_revenue_status) as rev, 0 as n from f_item group by all
union all select date_sk // 10000, (date_sk // 100 % 100 + 2) // 3, date_sk // 100 % 100, null, count(*) from f_order group by all)
group by rollup (y, q, m)""",
)
def _(r):
    return reports.calendar_drill(r.star, ["revenue", "order_attempts"])


YQM = "date_sk // 10000 as y, (date_sk // 100 % 100 + 2) // 3 as q, date_sk // 100 % 100 as m"


@query(
    "q25_calendar_drill_distinct",
    "year:i quarter:i month:i level:i revenue:M distinct_products_sold:i refunded_orders:i",
    f"""select y as year, q as quarter, m as month, level, max(rev) as revenue, max(dp) as distinct_products_sold, max(ro) as refunded_orders from (
select y, q, m, 3 - (grouping(y) + grouping(q) + grouping(m)) as level, sum(line_revenue_usd) filter (where is_revenue_status) as rev,
nullif(count(distinct product_sk) filter (where is_revenue_status), 0) as dp, null as ro from (select *, {YQM} from f_item) group by rollup (y, q, m)
union all select y, q, m, 3 - (grouping(y) + grouping(q) + grouping(m)), null, null, count(distinct order_sk) from (select *, {YQM} from f_refund) group by rollup (y, q, m)
) group by all""",
)
def _(r):
    """Distinct products and refunded orders at every level, from daily bitmaps."""
    return reports.calendar_drill(r.star, ["revenue", "distinct_products_sold", "refunded_orders"])


@query(
    "q2_distinct_in_batches",
    "month:i products:i in_range:i",
    f"""select date_sk // 100 as month, count(distinct product_sk) as products,
(select count(distinct product_sk) from f_item where is_revenue_status and date_sk between 19950310 and 19960425) as in_range
from f_item where is_revenue_status group by 1""",
)
def _(r):
    """Daily bitmaps kept up batch by batch, one written twice, with keys numbered as they
    turn up; then counted by month and over a range of days. Lines are told apart once, and
    the key texts are moved as bytes."""
    path, rows = r.folder("bitmaps"), distinct.part_rows(r.star, "distinct_products_sold")
    batch, numbers = F.pmod(F.xxhash64("order_sk"), F.lit(3)).alias("batch"), None
    rows = settle(rows.select("date_sk", F.unhex("product_sk").alias("product_sk"), batch))
    for i in (0, 1, 1, 2):
        new = rows.filter(F.col("batch") == i)
        numbers = settle(distinct.number_keys(new, "product_sk", numbers))
        distinct.append(new, "product_sk", numbers, path, i)
    days = distinct.read(r.spark, path)
    monthly = distinct.united(days.withColumn("month", F.floor(F.col("date_sk") / 100)), ["month"])
    chosen = distinct.between(days, 19950310, 19960425, "in_range")
    return distinct.counted(monthly, ["month"], "products").withColumn("in_range", chosen.scalar())


@query(
    "q25_drill_ratios_by_quarter",
    "year:i quarter:i profit_margin:r distinct_products_sold:i",
    f"""select year, quarter, {ratio('max(p)', 'max(n)')} as profit_margin, max(dp) as distinct_products_sold from (
select date_sk // 10000 as year, (date_sk // 100 % 100 + 2) // 3 as quarter, sum(profit) as p, sum(net) as n, null as dp from m_order group by all
union all select date_sk // 10000, (date_sk // 100 % 100 + 2) // 3, null, null, count(distinct product_sk) {LINE} from f_item group by all) group by all""",
)
def _(r):
    return evaluate(r.star, ["profit_margin", "distinct_products_sold"], ["year", "quarter"])


OVERVIEW_SPEC = " ".join(
    [
        "revenue:M quantity_sold:i distinct_products_sold:i refund_amount:M refunded_orders:i paid_orders:i cogs:M payment_fee:M",
        "design_fee:M profit_base_net_revenue:M contribution_profit:M shipping_charged:M product_profit:M product_net_revenue:M",
        "order_attempts:i completed_orders:i failed_orders:i cancelled_orders:i open_backlog:i method_paid_orders:i markets_served:i",
        "distinct_customers:i repeat_customers:i seg_lifetime_revenue:M net_revenue:M aov:R avg_units_per_order:R total_cost:M",
        "profit_margin:r cost_ratio:r cogs_ratio:r cost_per_order:R cost_per_unit:R cogs_per_unit:R product_margin:r",
        "paid_success_rate:r failed_rate:r cancellation_rate:r refund_rate:r payment_fee_rate:r method_approval_rate:r method_lost:i",
        "method_fee_rate:r orders_per_customer:r repeat_rate:r one_time_share:r lapsed_share:r new_customers:i seg_ltv:R seg_revenue_per_order:R",
    ]
)


@query("q26_overview", OVERVIEW_SPEC, cut_sql(list(FACTS), []))
def _(r):
    return reports.overview(r.star)


@query(
    "q27_revenue_in_scope",
    "revenue:M",
    """select sum(line_revenue_usd) as revenue from f_item where is_revenue_status and k in
(select k from f_order join d_country using (country_sk) where country_name in ('Nation 1', 'Nation 3'))""",
)
def _(r):
    named = r.star.dim_country.filter(F.col("country_name").isin("Nation 1", "Nation 3"))
    return reports.revenue_in_scope(r.star, r.star.fact_order.join(named, "country_sk", "left_semi"))
