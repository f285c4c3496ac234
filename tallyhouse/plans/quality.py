"""The star's declared checks and its coverage gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import percent
from tallyhouse.operators.checks import check_table
from tallyhouse.operators.joins import with_rate
from tallyhouse.plans.facts import ORDER
from tallyhouse.plans.recon import revenue_orders

# Accepted labels.
STATES = ["completed", "processing", "cancelled", "failed", "refunded", "pending"]
CURRENCIES = ["USD", "EUR", "GBP", "CAD"]
FEE_SOURCES = ["api_exact", "plugin_parser", "seed_estimate", "missing"]
ALLOCATIONS = ["line_exact", "allocated_by_revenue_share", "allocated_by_quantity_share", "order_only"]
EVENTS = ["refund", "cancellation"]
COST_SOURCES = ["manual_csv", "supplier_api"]

CONFORMED = {
    "country_sk": "dim_country", "customer_sk": "dim_customer_anonymized", "payment_method_sk": "dim_payment_method",
}
PLACE = {"site_sk": "dim_site", "date_sk": "dim_date"}
TO_ORDER = {"order_sk": "fact_order"}

#: Name under which the rows of a table are counted beside its rules.
ROWS = "rows"
COUNTED = "model string, rule string, violations bigint"

# Raw tables: what was landed, by the name of its input.
RAW = {
    "raw_orders": "orders", "raw_order_items": "order_items", "raw_products": "products", "raw_customers": "customers",
    "raw_refunds": "refunds", "raw_coupons": "coupons", "raw_cost": "cost_sheet",
}


def _landed(*keys: str) -> dict:
    return {"unique": [keys], "not_null": list(keys)}


# table -> its rules: keys that are unique, columns never NULL, accepted labels,
# parents of foreign keys, conditions every row meets (or every row of a kind), and
# the table it has as many rows as.
SUITE: dict[str, dict] = {
    "raw_orders": _landed("site_code", "woo_order_id"),
    "raw_order_items": _landed("site_code", "woo_order_id", "woo_order_item_id"),
    "raw_products": _landed("site_code", "woo_product_id"),
    "raw_customers": {"not_null": ["site_code", "woo_customer_id"]},
    "raw_refunds": {**_landed("site_code", "woo_refund_id"), "not_null": ["site_code", "woo_refund_id", "woo_order_id"]},
    "raw_coupons": _landed("site_code", "woo_coupon_id"),
    "raw_cost": _landed("site_code", "woo_order_id"),
    "stg_customers": {"not_null": ["woo_customer_id"]},
    "stg_coupons": {"unique": ["woo_coupon_id"], "not_null": ["woo_coupon_id"]},
    "recon_unmatched_csv_cost": {"not_null": ["site_code", "order_code"]},
    "stg_orders": {
        "same_rows": "raw_orders",
        "unique": ["order_natural_key"],
        "not_null": ["order_natural_key", "woo_order_id", "customer_hash", "currency_source"],
        "accepted": {"status": STATES, "currency_source": CURRENCIES},
    },
    "stg_order_items": {
        "unique": [("site_code", "woo_order_id", "woo_order_item_id")],
        "not_null": ["woo_order_item_id", "quantity"],
    },
    "stg_products": {"unique": [("site_code", "woo_product_id")], "not_null": ["site_code", "woo_product_id"]},
    "stg_refunds": {
        "unique": [("site_code", "woo_refund_id")],
        "not_null": ["site_code", "woo_refund_id", "woo_order_id", "refund_amount_src", "refund_date"],
        "holds": {"refund_amount_src >= 0": lambda: F.col("refund_amount_src") >= 0},
    },
    "stg_cost": {
        "unique": [("site_code", "woo_order_id")],
        "not_null": ["site_code", "woo_order_id", "cost_source", "cost_allocation_method", "cost_confidence"],
        "holds": {"cost_confidence between 0 and 1": lambda: F.col("cost_confidence").between(0, 1)},
    },
    "dim_date": {"unique": ["date_sk", "date_day"], "not_null": ["date_sk", "date_day"]},
    "dim_site": {"unique": ["site_sk", "site_code"], "not_null": ["site_sk", "site_code"]},
    "dim_country": {"unique": ["country_sk", "country_code"], "not_null": ["country_sk", "country_code"]},
    "dim_product": {"unique": ["product_sk"], "not_null": ["product_sk", "site_sk"], "parents": {"site_sk": "dim_site"}},
    "dim_customer_anonymized": {"unique": ["customer_sk", "customer_hash"], "not_null": ["customer_sk", "customer_hash"]},
    "dim_payment_method": {"unique": ["payment_method_sk", "method_code"], "not_null": ["payment_method_sk", "method_code"]},
    "fact_order": {
        "unique": ["order_sk", "order_natural_key"],
        "not_null": ["order_sk", "order_natural_key", *PLACE, *CONFORMED, "currency_source", "fx_rate_to_usd", "order_total_usd", "payment_fee_source"],
        "accepted": {"status": STATES, "currency_source": CURRENCIES, "payment_fee_source": FEE_SOURCES},
        "parents": {**PLACE, **CONFORMED},
    },
    "fact_order_item": {
        "unique": ["order_item_sk"],
        "not_null": ["order_item_sk", "order_sk", *PLACE, "product_sk", *CONFORMED, "quantity", "fx_rate_to_usd", "line_revenue_usd", "order_status", "is_revenue_status"],
        "accepted": {"order_status": STATES},
        "parents": {**TO_ORDER, **PLACE, "product_sk": "dim_product", **CONFORMED},
        "holds": {"line_revenue_usd >= 0": lambda: F.col("line_revenue_usd") >= 0, "quantity > 0": lambda: F.col("quantity") > 0},
        "holds_where": {"line_revenue_usd >= 0": "line_revenue_usd is not null"},
    },
    "fact_refund": {
        "unique": ["refund_sk"],
        "not_null": ["refund_sk", "order_sk", *PLACE, *CONFORMED, "refund_amount_usd", "event_type"],
        "accepted": {"event_type": EVENTS},
        "parents": {**TO_ORDER, **PLACE, **CONFORMED},
        "holds": {"refund_amount_usd >= 0": lambda: F.col("refund_amount_usd") >= 0},
    },
    "fact_order_cost": {
        "unique": ["order_cost_sk"],
        "not_null": ["order_cost_sk", "order_sk", *PLACE, *CONFORMED, "cost_source", "cost_allocation_method"],
        "accepted": {"cost_source": COST_SOURCES, "cost_allocation_method": ALLOCATIONS},
        "parents": {**TO_ORDER, **PLACE, **CONFORMED},
        "holds": {"cost_confidence between 0 and 1": lambda: F.col("cost_confidence").between(0, 1)},
    },
    "mart_order_profit": {
        "unique": ["order_sk"],
        "not_null": ["order_sk", *CONFORMED, "order_status", "gross_product_revenue_usd", "shipping_charged_usd", "gross_revenue_usd", "refunds_usd", "effective_refund_usd", "net_revenue_usd", "revenue_usd"],
        "accepted": {"order_status": STATES, "payment_fee_source": FEE_SOURCES, "cost_allocation_method": ALLOCATIONS},
        "parents": {**TO_ORDER, **CONFORMED},
    },
    "mart_product_profit": {
        "unique": ["order_item_sk"],
        "not_null": ["order_item_sk", "order_sk", *CONFORMED, "order_status"],
        "accepted": {"order_status": STATES, "cost_allocation_method": ALLOCATIONS},
        "parents": {"order_item_sk": "fact_order_item", **TO_ORDER, **CONFORMED},
    },
    "mart_customer_summary": {
        "unique": ["customer_sk", "customer_hash"],
        "not_null": ["customer_sk", "customer_hash", "total_orders", "total_revenue_usd", "first_order_month"],
    },
}


def _row_rules(rules: dict) -> dict[str, Column]:
    out = {f"not_null {c}": F.col(c).isNotNull() for c in rules.get("not_null", [])}
    out |= {f"accepted {c}": F.col(c).isin(*v) for c, v in rules.get("accepted", {}).items()}
    out |= {name: condition() for name, condition in rules.get("holds", {}).items()}
    out |= {f"{rule} where {kind}": ~F.expr(kind) | F.expr(rule) for rule, kind in rules.get("holds_where", {}).items()}
    return out


def row_rules_of(table: str) -> dict[str, Column]:
    """The rules of a table that each row meets or breaks by itself."""
    return _row_rules(SUITE.get(table, {}))


def table_of(star, table: str) -> DataFrame:
    return getattr(star.inputs, RAW[table]) if table in RAW else getattr(star, table)


def _counted(star, table: str) -> DataFrame:
    """Rows and broken row rules of a table: counted while it was written, if it still is
    the table the star has, or now."""
    df = table_of(star, table)
    if getattr(star, "written", {}).get(table) is df:
        return star.row_rules.filter(F.col("model") == table).select("rule", "violations")
    return check_table(df, {ROWS: F.lit(False), **row_rules_of(table)})


def _row_counts(star, table: str, other: str) -> DataFrame:
    """By how many rows two tables differ."""
    ours, theirs = (_counted(star, t).filter(F.col("rule") == ROWS).select(F.col("violations").alias(n)) for t, n in ((table, "n"), (other, "m")))
    other_rows = theirs.scalar()
    return ours.select(F.lit(f"as many rows as {other}").alias("rule"), F.abs(F.col("n") - other_rows).alias("violations"))


def _duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count_if(F.col("n") > 1).alias("violations")).select(
        F.lit(f"unique {' '.join(keys)}").alias("rule"), "violations"
    )


def _orphans(df: DataFrame, parents: dict[str, str], star) -> DataFrame:
    """Distinct keys without a parent, for all foreign keys of a table in one scan.

    Every key becomes a (rule, key) pair; pairs are made distinct before the join,
    so a hot key is one row per map task.
    """
    names = {fk: f"{fk} in {table}" for fk, table in parents.items()}
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(fk).cast("string").alias("key")) for fk, n in names.items()])
    keys = df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("key").isNotNull()).distinct()
    known = reduce(
        DataFrame.unionByName,
        [table_of(star, t).select(F.lit(names[fk]).alias("rule"), F.col(fk).cast("string").alias("key")) for fk, t in parents.items()],
    )
    lost = keys.join(known, ["rule", "key"], "left_anti").groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))
    every = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names.values()])).alias("rule"))
    return every.join(lost, "rule", "left").select("rule", F.coalesce("violations", F.lit(0)).alias("violations"))


def suite_of(star, table: str) -> DataFrame:
    """All rules of one table: row rules as counted on write, one pass for foreign keys, one
    per unique key. Tables that are not written take one pass for their row rules."""
    rules, df = SUITE[table], table_of(star, table)
    results = [_counted(star, table).filter(F.col("rule") != ROWS)]
    for key in rules.get("unique", []):
        results.append(_duplicates(df, [key] if isinstance(key, str) else list(key)))
    if "parents" in rules:
        results.append(_orphans(df, rules["parents"], star))
    if "same_rows" in rules:
        results.append(_row_counts(star, table, rules["same_rows"]))
    return reduce(DataFrame.unionByName, results).withColumn("model", F.lit(table))


def run_suite(star, tables: list[str] | None = None) -> DataFrame:
    """``(model, rule, severity, violations)`` for every declared rule."""
    rows = reduce(DataFrame.unionByName, [suite_of(star, t) for t in tables or SUITE])
    return rows.select("model", "rule", F.lit("error").alias("severity"), F.col("violations").cast("bigint"))


def _gate(counts: DataFrame, num: str, den: str, pct: str, minimum: int) -> DataFrame:
    """The row of figures when coverage is below the minimum; no row is a pass."""
    low = F.col(num) * 100 < F.col(den) * minimum
    return counts.filter((F.col(den) > 0) & low).select(num, den, percent(num, den).alias(pct))


def cost_coverage_gate(star, minimum: int = 95) -> DataFrame:
    """A warning: share of revenue orders with a real cost."""
    orders = revenue_orders(star.fact_order_item)
    costs = star.fact_order_cost.groupBy(*ORDER).agg(F.max("cogs_usd").alias("_cogs"))
    counts = orders.join(costs, ORDER, "left").agg(
        F.count_if(F.col("_cogs") > 0).alias("covered_revenue_orders"), F.count(F.lit(1)).alias("revenue_orders")
    )
    return _gate(counts, "covered_revenue_orders", "revenue_orders", "cost_coverage_pct", minimum)


def fee_coverage_gate(star, minimum: int = 80) -> DataFrame:
    """A warning: share of revenue orders with a known payment fee."""
    orders = star.fact_order.join(revenue_orders(star.fact_order_item), ORDER, "left_semi")
    counts = orders.agg(F.count("payment_fee_usd").alias("orders_with_fee"), F.count(F.lit(1)).alias("revenue_orders"))
    return _gate(counts, "orders_with_fee", "revenue_orders", "payment_fee_coverage_pct", minimum)


def missing_rates(orders: DataFrame, fx: DataFrame) -> DataFrame:
    """Orders per currency whose rate is missing and so counts as one."""
    rated = with_rate(orders.select("currency_source", "order_date"), fx, "currency_source", "order_date", "_rate")
    return rated.filter(F.col("_rate").isNull()).groupBy("currency_source").agg(F.count(F.lit(1)).alias("orders"))
