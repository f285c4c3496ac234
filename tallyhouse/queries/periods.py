"""Period-over-period queries (D rows and W7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.plans import days
from tallyhouse.plans.period import last_data_date, period_delta
from tallyhouse.queries.oracle_tables import ratio
from tallyhouse.queries.registry import query

DAY = "strptime(date_sk::varchar, '%Y%m%d')::date"
MONTH1 = "date_trunc('month', a)::date"
# kind -> first and last day of the current and the previous window, from anchor a
WINDOWS = {
    "MoM": (MONTH1, "last_day(a)", f"({MONTH1} - interval 1 month)", f"last_day(({MONTH1} - interval 1 month)::date)"),
    "YoY": (MONTH1, "last_day(a)", f"({MONTH1} - interval 12 month)", f"last_day(({MONTH1} - interval 12 month)::date)"),
    "MoM_MTD": (MONTH1, "a", f"({MONTH1} - interval 1 month)", "(a - interval 1 month)"),
    "YoY_MTD": (MONTH1, "a", f"({MONTH1} - interval 12 month)", "(a - interval 12 month)"),
    "QoQ": ("date_trunc('quarter', a)", "a", "(date_trunc('quarter', a) - interval 3 month)", "(a - interval 3 month)"),
    "YTD": ("date_trunc('year', a)", "a", "(date_trunc('year', a) - interval 12 month)", "(a - interval 12 month)"),
    "WoW": ("a - 6", "a", "a - 13", "a - 7"),
    "DoD": ("a", "a", "a - 1", "a - 1"),
    "T12M": ("(a - interval 12 month + interval 1 day)", "a", "(a - interval 24 month + interval 1 day)", "(a - interval 12 month)"),
}
WINDOWS["YoY_YTD"] = WINDOWS["YTD"]
REVENUE_DAYS = f"select country_name, {DAY} as d, line_revenue_usd as x from f_item join d_country using (country_sk) where is_revenue_status"


def delta_sql(kind: str) -> str:
    lo, hi, plo, phi = WINDOWS[kind]
    return f"""select country_name, c as current_value, p as previous_value, {ratio('coalesce(c, 0) - p', 'p')} as delta from (
select country_name, sum(x) filter (where d >= {lo} and d <= {hi}) as c, sum(x) filter (where d >= {plo} and d <= {phi}) as p
from (select *, max(d) over (partition by country_name) as a from ({REVENUE_DAYS})) group by 1)"""


NAMES = {
    "d1_mom": "MoM", "d2_yoy": "YoY", "d4_mom_mtd": "MoM_MTD", "d5_yoy_mtd": "YoY_MTD", "d6_qoq": "QoQ", "d7_ytd": "YTD",
    "d7_yoy_ytd": "YoY_YTD", "d8_wow": "WoW", "d9_dod": "DoD", "d10_t12m": "T12M",
}
SPEC = "country_name:s current_value:M previous_value:M delta:r"


def _register(name: str, kind: str) -> None:
    query(name, SPEC, delta_sql(kind))(lambda r: period_delta(r.star, "revenue", kind, ["country_name"]))


for _name, _kind in NAMES.items():
    _register(_name, _kind)


def selected_sql(plo: str, phi: str) -> str:
    return f"""select country_name, c as current_value, p as previous_value, {ratio('coalesce(c, 0) - p', 'p')} as delta from (
select country_name, sum(x) filter (where d between date '1998-02-10' and date '1998-05-20') as c, sum(x) filter (where d between {plo} and {phi}) as p
from ({REVENUE_DAYS}) group by 1) where c is not null or p is not null"""


SELECTION = ("1998-02-10", "1998-05-20")


@query("d3_pop", SPEC, selected_sql("date '1997-11-02'", "date '1998-02-09'"))
def _(r):
    return period_delta(r.star, "revenue", "PoP", ["country_name"], SELECTION)


@query("d11_same_period_last_year", SPEC, selected_sql("date '1997-02-10'", "date '1997-05-20'"))
def _(r):
    return period_delta(r.star, "revenue", "SPLY", ["country_name"], SELECTION)


@query(
    "d1_mom_margin_total",
    "current_value:r previous_value:r delta:r",
    f"""select c as current_value, p as previous_value, {ratio('c - p', 'p')} as delta from (
select {ratio('sum(profit) filter (where d >= ' + MONTH1 + ' and d <= last_day(a))', 'sum(net) filter (where d >= ' + MONTH1 + ' and d <= last_day(a))')} as c,
{ratio('sum(profit) filter (where d >= ' + WINDOWS['MoM'][2] + ' and d <= ' + WINDOWS['MoM'][3] + ')', 'sum(net) filter (where d >= ' + WINDOWS['MoM'][2] + ' and d <= ' + WINDOWS['MoM'][3] + ')')} as p
from (select profit, net, d, max(case when dn <> 0 then d end) over () as a from (select *, {DAY} as d, sum(net) over (partition by date_sk) as dn from m_order)))""",
)
def _(r):
    """A ratio: both windows are summed first, then divided."""
    return period_delta(r.star, "profit_margin", "MoM")


@query(
    "d2_yoy_refunded_orders",
    "country_name:s current_value:i previous_value:i delta:r",
    f"""select country_name, c as current_value, p as previous_value, {ratio('coalesce(c, 0) - p', 'p')} as delta from (
select country_name, nullif(count(distinct order_sk) filter (where d >= {WINDOWS['YTD'][0]} and d <= a), 0) as c,
nullif(count(distinct order_sk) filter (where d >= {WINDOWS['YTD'][2]} and d <= {WINDOWS['YTD'][3]}), 0) as p
from (select *, max(d) over (partition by country_name) as a from (select country_name, order_sk, {DAY} as d from f_refund join d_country using (country_sk))) group by 1)""",
)
def _(r):
    """A distinct count: keys are counted per window, not added up over days."""
    return period_delta(r.star, "refunded_orders", "YTD", ["country_name"])


@query(
    "d10_t12m_paid_orders_selected",
    "current_value:i previous_value:i delta:r",
    f"""select c as current_value, p as previous_value, {ratio('c - p', 'p')} as delta from (
select count(*) filter (where d > a - interval 12 month and d <= a) as c, count(*) filter (where d > a - interval 24 month and d <= a - interval 12 month) as p
from (select {DAY} as d, (select max({DAY}) from m_order where date_sk between 19980210 and 19980520) as a from m_order))""",
)
def _(r):
    """The anchor is taken inside the selection; the windows reach beyond it."""
    return period_delta(r.star, "paid_orders", "T12M", selection=SELECTION)


@query("w7_last_data_date", "country_name:s last_data_date:d", f"select country_name, max(d) as last_data_date from ({REVENUE_DAYS}) group by 1")
def _(r):
    return last_data_date(r.star, "revenue", ["country_name"])


@query(
    "w7_day_summary_in_batches",
    "date_sk:i country_sk:s revenue:m quantity_sold:i last_day:i",
    """select date_sk, country_sk, sum(case when is_revenue_status then line_revenue_usd end) as revenue, sum(case when is_revenue_status then quantity end) as quantity_sold,
max(date_sk) over (partition by country_sk) as last_day from f_item group by date_sk, country_sk""",
)
def _(r):
    """The summary kept up batch by batch, one of them written twice, then compacted and
    appended to: as if made at once."""
    path, kept, fact = r.folder("days"), r.folder("compacted"), "fact_order_item"
    batch = F.pmod(F.xxhash64("order_sk"), F.lit(3))
    for i in (0, 1, 1):
        days.append(r.star.fact_order_item.filter(batch == i), fact, path, i)
    days.compact(r.spark, fact, path, kept)
    days.append(r.star.fact_order_item.filter(batch == 2), fact, kept, 1)
    rows = days.read(r.spark, fact, kept).groupBy("date_sk", "country_sk").agg(F.sum("revenue").alias("revenue"), F.sum("quantity_sold").alias("quantity_sold"))
    last = rows.groupBy("country_sk").agg(F.max("date_sk").alias("last_day"))
    return rows.join(last, "country_sk")


@query("w7_last_refund_by_site", "site_code:s last_data_date:d", f"select 'S' || (k % 5) as site_code, max({DAY}) as last_data_date from f_refund group by 1")
def _(r):
    """A distinct count that is blank on days without a refund."""
    return last_data_date(r.star, "refunded_orders", ["site_code"])
