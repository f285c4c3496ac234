"""Data-quality checks as queries (X rows): each returns its violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.operators import checks
from tallyhouse.operators.setops import set_diff
from tallyhouse.plans import quality
from tallyhouse.plans.facts import ORDER
from tallyhouse.queries.registry import compose, oracle_sql, query


@query("x1_not_null", "woo_order_id:i", "select k as woo_order_id from stg_o where country is null")
def _(r):
    return checks.check_not_null(r.star.stg_orders, "billing_country_code")


@query("x2_unique", "customer_hash:s n_records:i", "select customer_hash, count(*) as n_records from stg_o group by 1 having count(*) > 1")
def _(r):
    return checks.check_unique(r.star.stg_orders, ["customer_hash"])


@query(
    "x3_unique_combination",
    "l_orderkey:i l_linenumber:i n_records:i",
    "select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by all having count(*) > 1",
)
def _(r):
    return checks.check_unique(r.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("x4_accepted_values", "status:s n_records:i", "select status, count(*) as n_records from base_order where status not in ('completed', 'processing') group by 1")
def _(r):
    return checks.check_accepted_values(r.star.fact_order, "status", ["completed", "processing"])


@query("x5_relationships", "fk:i", "select distinct l_partkey as fk from lineitem where l_partkey % 50 = 0")
def _(r):
    return checks.check_relationship(r.table("lineitem"), "l_partkey", r.wh.stg_products, "woo_product_id")


@query("x6_equal_rowcount", "n_left:i n_right:i", "select (select count(*) from base_order) as n_left, (select count(*) from f_cost) as n_right")
def _(r):
    return checks.check_equal_rowcount(r.star.stg_orders, r.star.fact_order_cost)


@query("x7_expression_is_true", "order_item_sk:s quantity:i", "select order_item_sk, quantity from f_item where not quantity < 50")
def _(r):
    return checks.check_expression(r.star.fact_order_item, F.col("quantity") < 50)


@query("x8_between_where", "order_item_sk:s line_revenue_usd:m", "select order_item_sk, line_revenue_usd from f_item where status = 'pending' and not line_revenue_usd between 1000 and 90000")
def _(r):
    return checks.check_between(r.star.fact_order_item, "line_revenue_usd", 1000, 90000, F.col("order_status") == "pending")


@query(
    "x9_cost_coverage_gate",
    "covered_revenue_orders:i revenue_orders:i cost_coverage_pct:R",
    """select * from (select count(*) filter (where cogs_usd > 0) as covered_revenue_orders, count(*) as revenue_orders,
round(100.0 * count(*) filter (where cogs_usd > 0) / count(*), 2) as cost_coverage_pct from rev_set left join (select k, cogs_usd from f_cost) using (k))
where 100.0 * covered_revenue_orders / revenue_orders < 95""",
)
def _(r):
    return quality.cost_coverage_gate(r.star)


@query(
    "x9_fee_coverage_gate",
    "orders_with_fee:i revenue_orders:i payment_fee_coverage_pct:R",
    """select * from (select count(payment_fee_usd) as orders_with_fee, count(*) as revenue_orders,
round(100.0 * count(payment_fee_usd) / count(*), 2) as payment_fee_coverage_pct from rev_set join f_order using (k))
where 100.0 * orders_with_fee / revenue_orders < 95""",
)
def _(r):
    return quality.fee_coverage_gate(r.star, minimum=95)


@query(
    "x10_set_parity",
    "site_code:s issue:s",
    """select site_code, case when n = 1 then 'missing_from_seed' else 'unexpected_in_seed' end as issue from (
select coalesce(a.site_code, b.site_code) as site_code, case when b.site_code is null then 1 else 2 end as n
from (select distinct 'S' || (o_orderkey % 5) as site_code from orders) a
full join (select 'S' || r_regionkey as site_code from region where r_regionkey <> 4) b on a.site_code = b.site_code
where a.site_code is null or b.site_code is null)""",
)
def _(r):
    """Sites met in the orders against the active ones of the seed."""
    met = r.star.fact_order.select("site_code").distinct()
    return set_diff(met, r.star.dim_site.filter("is_active"), "site_code")


@query("x11_conservation", "site_code:s woo_order_id:i", "select site_code, k as woo_order_id from (select site_code, k, sum(line_profit) as s, max(profit) as p, count(*) as n from m_line join (select k, profit from m_order) using (k) group by all) where abs(s - p) > n * 0.000001")
def _(r):
    return checks.check_conservation(r.star.mart_product_profit, "line_profit_usd", r.star.mart_order_profit, "contribution_profit_usd", ORDER)


@query(
    "x11_conserved_totals",
    "site_sk:s lines:i line_profit:M order_profit:R",
    """select site_sk, lines, line_profit, order_profit from (select site_sk, count(*) as lines, sum(line_profit) as line_profit from m_line group by 1)
join (select site_sk, round(sum(profit)::double, 2) as order_profit from m_order group by 1) using (site_sk)""",
)
def _(r):
    lines = r.star.mart_product_profit.groupBy("site_sk").agg(F.count(F.lit(1)).alias("lines"), F.sum("line_profit_usd").alias("line_profit"))
    orders = r.star.mart_order_profit.groupBy("site_sk").agg(F.round(F.sum("contribution_profit_usd"), 2).alias("order_profit"))
    return lines.join(orders, "site_sk")


@query(
    "x_line_rules_one_pass",
    "rule:s violations:i",
    """select 'revenue_not_negative' as rule, count(*) filter (where line_revenue_usd < 0) as violations from f_item
union all select 'quantity_positive', count(*) filter (where quantity <= 0) from f_item
union all select 'style_known', count(*) filter (where style is null) from f_item
union all select 'quantity_below_40', count(*) filter (where quantity >= 40) from f_item""",
)
def _(r):
    return checks.check_table(
        r.star.fact_order_item,
        {
            "revenue_not_negative": F.col("line_revenue_usd") >= 0,
            "quantity_positive": F.col("quantity") > 0,
            "style_known": F.col("style").isNotNull(),
            "quantity_below_40": F.col("quantity") < 40,
        },
    )


@query("x_t2_missing_rates", "currency_source:s orders:i", "select ccy as currency_source, count(*) as orders from base_order o where not exists (select 1 from fx_quote q where q.ccy = o.ccy and q.month = date_trunc('month', o.order_date)) group by 1")
def _(r):
    return quality.missing_rates(r.star.stg_orders, r.wh.fx)


# Keys of what was landed.
RAW_SQL = {
    "raw_orders": "select 'S' || (o_orderkey % 5) as site_code, o_orderkey as woo_order_id from orders",
    "raw_order_items": compose("select site_code, k as woo_order_id, item_id as woo_order_item_id from stg_i", "site_code:s woo_order_id:i woo_order_item_id:i"),
    "raw_products": compose("select site_code, product_id as woo_product_id from stg_p", "site_code:s woo_product_id:i"),
    "raw_customers": "select 'S' || (c_custkey % 5) as site_code, c_custkey as woo_customer_id from customer join nation on c_nationkey = n_nationkey",
    "raw_refunds": compose("select site_code, refund_id as woo_refund_id, k as woo_order_id from stg_r", "site_code:s woo_refund_id:i woo_order_id:i"),
    "raw_coupons": "select 'S' || (s_suppkey % 5) as site_code, s_suppkey as woo_coupon_id from supplier",
    "raw_cost": compose("select site_code, k as woo_order_id from stg_c", "site_code:s woo_order_id:i"),
}


def suite_sql() -> str:
    """The declared rules over the SQL of the model queries, whose columns have the same names."""
    known = oracle_sql()
    source = {m: RAW_SQL[m] if m in RAW_SQL else next(sql for name, sql in known.items() if name.split("_", 1)[1] == m) for m in quality.SUITE}
    rows = []

    def rule(model: str, name: str, count: str) -> None:
        rows.append(f"select '{model}' as model, '{name}' as rule, ({count}) as violations")

    for m, rules in quality.SUITE.items():
        for c in rules.get("not_null", []):
            rule(m, f"not_null {c}", f"select count(*) from t_{m} where {c} is null")
        for c, labels in rules.get("accepted", {}).items():
            listed = ", ".join(f"'{x}'" for x in labels)
            rule(m, f"accepted {c}", f"select count(*) from t_{m} where {c} not in ({listed})")
        for condition in rules.get("holds", {}):
            rule(m, condition, f"select count(*) from t_{m} where not ({condition})")
        for condition, kind in rules.get("holds_where", {}).items():
            rule(m, f"{condition} where {kind}", f"select count(*) from t_{m} where {kind} and not ({condition})")
        if "same_rows" in rules:
            other = rules["same_rows"]
            rule(m, f"as many rows as {other}", f"select abs((select count(*) from t_{m}) - (select count(*) from t_{other}))")
        for key in rules.get("unique", []):
            keys = [key] if isinstance(key, str) else list(key)
            rule(m, f"unique {' '.join(keys)}", f"select count(*) from (select 1 from t_{m} group by {', '.join(keys)} having count(*) > 1)")
        for fk, parent in rules.get("parents", {}).items():
            rule(m, f"{fk} in {parent}", f"select count(distinct {fk}) from t_{m} where {fk} is not null and {fk} not in (select {fk} from t_{parent})")
    tables = ",\n".join(f"t_{m} as materialized ({sql})" for m, sql in source.items())
    union = "\nunion all ".join(rows)
    return f"select model, rule, 'error' as severity, violations from (with {tables}\n{union})"


@query("x_schema_suite", "model:s rule:s severity:s violations:i", suite_sql())
def _(r):
    return quality.run_suite(r.star)
