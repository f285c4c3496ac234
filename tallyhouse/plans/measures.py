"""Measures over the star, evaluated at any grain.

A measure is built from *parts*. A part is one aggregate of one fact: a sum, a row
count, or a count of distinct keys. ``evaluate`` aggregates every fact it needs to
the requested grain, stacks the small results, folds them to one row per group and
computes the measures from the parts. Facts are never joined to each other.

Sums and counts are first reduced to the fact's own foreign keys, so dimension
attributes are looked up on a reduced table. Distinct keys are reduced the same
way and counted after the lookup.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.clean import REVENUE_STATES
from tallyhouse.functions.keys import sk
from tallyhouse.functions.money import TOTAL, total_ratio
from tallyhouse.plans.facts import PRODUCT
from tallyhouse.plans.marts import customer_bands

# Star relationships: dimension -> its key column, and the attributes it offers.
DIMENSIONS = {
    "dim_date": ("date_sk", ("year", "quarter", "month", "month_name", "day_of_month", "date_day", "iso_day_of_week", "day_name", "is_weekend")),
    "dim_site": ("site_sk", ("site_code", "site_name")),
    "dim_country": ("country_sk", ("country_code", "country_name", "region")),
    "dim_payment_method": ("payment_method_sk", ("method_code", "method_name")),
    "dim_product": ("product_sk", ("product_name", "product_type", "woo_product_id")),
    "dim_customer_anonymized": ("customer_sk", ("customer_hash", "is_unknown_email")),
}
ATTRIBUTE_OF = {attr: dim for dim, (_, attrs) in DIMENSIONS.items() for attr in attrs}
KEYS = tuple(key for key, _ in DIMENSIONS.values())

# Foreign keys per fact; columns of the fact itself may be grouped by as well.
FACT_KEYS = {
    "fact_order": ("date_sk", "site_sk", "country_sk", "customer_sk", "payment_method_sk"),
    "fact_order_item": ("date_sk", "site_sk", "country_sk", "customer_sk", "payment_method_sk", "product_sk"),
    "fact_refund": ("date_sk", "site_sk", "country_sk", "customer_sk", "payment_method_sk"),
    "mart_order_profit": ("date_sk", "site_sk", "country_sk", "customer_sk", "payment_method_sk"),
    "mart_product_profit": ("date_sk", "site_sk", "country_sk", "customer_sk", "payment_method_sk", "product_sk"),
    "mart_customer_summary": ("customer_sk",),
}
OWN_COLUMNS = {
    "fact_order": ("status",),
    "mart_customer_summary": ("segment", "recency_segment", "clv_bucket", "first_order_month", "total_orders"),
}


@dataclass(frozen=True)
class Part:
    """One aggregate of a fact: ``sum`` or ``count`` of rows, or ``distinct`` keys."""

    fact: str
    kind: str
    column: str | None = None
    where: Callable[[], Column] | None = None

    def value(self) -> Column:
        base = F.lit(1).cast("bigint") if self.kind == "count" else F.col(self.column)
        return base if self.where is None else F.when(self.where(), base)


@dataclass(frozen=True)
class Measure:
    parts: dict[str, Part]
    formula: Callable[[dict[str, Column]], Column] = field(default=lambda p: next(iter(p.values())))


def _revenue_line() -> Column:
    return F.col("is_revenue_status")


def _status(*names: str) -> Callable[[], Column]:
    return lambda: F.col("status").isin(*names)


ITEM, ORDERS, PROFIT, REFUND, LINES, PEOPLE = (
    "fact_order_item", "fact_order", "mart_order_profit", "fact_refund", "mart_product_profit", "mart_customer_summary",
)
PARTS = {
    "revenue": Part(ITEM, "sum", "line_revenue_usd", _revenue_line),
    "quantity_sold": Part(ITEM, "sum", "quantity", _revenue_line),
    "distinct_products_sold": Part(ITEM, "distinct", "product_sk", _revenue_line),
    "refund_amount": Part(REFUND, "sum", "refund_amount_usd"),
    "refunded_orders": Part(REFUND, "distinct", "order_sk"),
    # one row per order, so rows are distinct orders
    "paid_orders": Part(PROFIT, "count"),
    "cogs": Part(PROFIT, "sum", "cogs_usd"),
    "payment_fee": Part(PROFIT, "sum", "payment_fee_usd"),
    "design_fee": Part(PROFIT, "sum", "design_fee_usd"),
    "profit_base_net_revenue": Part(PROFIT, "sum", "net_revenue_usd"),
    "contribution_profit": Part(PROFIT, "sum", "contribution_profit_usd"),
    "shipping_charged": Part(ORDERS, "sum", "shipping_charged_usd"),
    "product_profit": Part(LINES, "sum", "line_profit_usd"),
    "product_net_revenue": Part(LINES, "sum", "line_net_revenue_usd"),
    "order_attempts": Part(ORDERS, "count"),
    "completed_orders": Part(ORDERS, "count", None, _status("completed")),
    "failed_orders": Part(ORDERS, "count", None, _status("failed")),
    "cancelled_orders": Part(ORDERS, "count", None, _status("cancelled")),
    "open_backlog": Part(ORDERS, "count", None, _status("processing")),
    "method_paid_orders": Part(ORDERS, "count", None, _status(*REVENUE_STATES)),
    "_order_fee": Part(ORDERS, "sum", "payment_fee_usd"),
    "_order_total": Part(ORDERS, "sum", "order_total_usd"),
    "_paid_total": Part(ORDERS, "sum", "order_total_usd", _status(*REVENUE_STATES)),
    "markets_served": Part(ORDERS, "distinct", "country_sk"),
    # one row per customer, so rows are distinct customers
    "distinct_customers": Part(PEOPLE, "count"),
    "repeat_customers": Part(PEOPLE, "count", None, lambda: F.col("is_repeat")),
    "_customer_orders": Part(PEOPLE, "sum", "total_orders"),
    "seg_lifetime_revenue": Part(PEOPLE, "sum", "total_revenue_usd"),
    "_lapsed_customers": Part(PEOPLE, "count", None, lambda: F.col("recency_segment") == "Lapsed 12+mo"),
}


def _ratio(a: str, b: str) -> Measure:
    return Measure(_pick(a, b), lambda p: total_ratio(p[a], p[b]))


def _pick(*names: str) -> dict[str, Part]:
    return {n: PARTS[n] for n in names}


def _plus(*terms: Column) -> Column:
    """A sum in which a blank term counts as zero, blank when all are."""
    seen = F.coalesce(*[t.cast("double") for t in terms]).isNotNull()
    total = F.coalesce(terms[0], F.lit(0))
    for t in terms[1:]:
        total = total + F.coalesce(t, F.lit(0))
    return F.when(seen, total)


def _total_cost(p: dict[str, Column]) -> Column:
    return _plus(p["cogs"], p["design_fee"], p["payment_fee"])


COSTS = ("cogs", "design_fee", "payment_fee")

MEASURES: dict[str, Measure] = {n: Measure({n: part}) for n, part in PARTS.items() if not n.startswith("_")} | {
    "net_revenue": Measure(_pick("revenue", "refund_amount"), lambda p: _plus(p["revenue"], -p["refund_amount"])),
    "aov": _ratio("revenue", "paid_orders"),
    "avg_units_per_order": _ratio("quantity_sold", "paid_orders"),
    "total_cost": Measure(_pick(*COSTS), _total_cost),
    "profit_margin": _ratio("contribution_profit", "profit_base_net_revenue"),
    "cost_ratio": Measure(
        _pick(*COSTS, "profit_base_net_revenue"), lambda p: total_ratio(_total_cost(p), p["profit_base_net_revenue"])
    ),
    "cogs_ratio": _ratio("cogs", "profit_base_net_revenue"),
    "cost_per_order": Measure(_pick(*COSTS, "paid_orders"), lambda p: total_ratio(_total_cost(p), p["paid_orders"])),
    "cost_per_unit": Measure(_pick(*COSTS, "quantity_sold"), lambda p: total_ratio(_total_cost(p), p["quantity_sold"])),
    "cogs_per_unit": _ratio("cogs", "quantity_sold"),
    "product_margin": _ratio("product_profit", "product_net_revenue"),
    "paid_success_rate": _ratio("paid_orders", "order_attempts"),
    "failed_rate": _ratio("failed_orders", "order_attempts"),
    "cancellation_rate": _ratio("cancelled_orders", "order_attempts"),
    "refund_rate": _ratio("refunded_orders", "paid_orders"),
    "payment_fee_rate": _ratio("_order_fee", "_order_total"),
    "method_approval_rate": _ratio("method_paid_orders", "order_attempts"),
    "method_lost": Measure(
        _pick("order_attempts", "method_paid_orders"), lambda p: _plus(p["order_attempts"], -p["method_paid_orders"])
    ),
    "method_fee_rate": _ratio("payment_fee", "_paid_total"),
    "orders_per_customer": _ratio("_customer_orders", "distinct_customers"),
    "repeat_rate": _ratio("repeat_customers", "distinct_customers"),
    "one_time_share": Measure(
        _pick("repeat_customers", "distinct_customers"),
        lambda p: F.lit(1) - F.coalesce(total_ratio(p["repeat_customers"], p["distinct_customers"]), F.lit(0)),
    ),
    "lapsed_share": _ratio("_lapsed_customers", "distinct_customers"),
    "new_customers": Measure(_pick("distinct_customers")),
    "seg_ltv": _ratio("seg_lifetime_revenue", "distinct_customers"),
    "seg_revenue_per_order": _ratio("seg_lifetime_revenue", "_customer_orders"),
}


def parts_of(names: list[str]) -> dict[str, Part]:
    return {n: p for name in names for n, p in MEASURES[name].parts.items()}


def value(name: str, prefix: str = "") -> Column:
    """A measure over folded part columns named ``prefix + part``."""
    m = MEASURES[name]
    return m.formula({n: F.col(f"`{prefix}{n}`") for n in m.parts})


def formulas(names: list[str]) -> list[Column]:
    return [value(name).alias(name) for name in names]


def fact_table(star, fact: str) -> DataFrame:
    df = getattr(star, fact)
    return customer_bands(df) if fact == PEOPLE else df


def group_columns(fact: str, by: list[str]) -> tuple[list[str], list[str]]:
    """Foreign keys and own columns of the fact that serve the group-by list."""
    keys, own = [], []
    for c in by:
        if c in FACT_KEYS[fact]:
            keys.append(c)
        elif c in OWN_COLUMNS.get(fact, ()):
            own.append(c)
        else:
            dim = ATTRIBUTE_OF.get(c)
            key = DIMENSIONS[dim][0] if dim else None
            if key not in FACT_KEYS[fact]:
                raise ValueError(f"{fact} has no relationship to {c}")
            keys.append(key)
    return list(dict.fromkeys(keys)), own


def slice_by(star, df: DataFrame, by: list[str]) -> DataFrame:
    """Look up the attributes in ``by`` over the keys the table carries."""
    for dim, (key, attrs) in DIMENSIONS.items():
        wanted = [a for a in by if a in attrs and a not in df.columns]
        if wanted:
            table = getattr(star, dim).select(key, *wanted)
            # Products grow with the shop. Their key texts are in no file and their names lie in
            # dictionaries: Spark takes them for far less than they are, and would send them all.
            table = table.hint("merge") if dim == "dim_product" else table
            df = df.join(table, key, "left")
    return df


def _grouped(df: DataFrame, group: list[str], sums: list[Column]) -> DataFrame:
    """Sums per group. Key texts of products are random and would be most of what is moved:
    their two ids are grouped by instead, and the key is made behind the shuffle."""
    if "product_sk" not in group or not set(PRODUCT) <= set(df.columns):
        return df.groupBy(*group).agg(*sums)
    ids = dict.fromkeys([*(c for c in group if c != "product_sk"), *PRODUCT])
    small = df.groupBy(*ids).agg(*sums)
    made = [sk(*PRODUCT).alias(c) if c == "product_sk" else F.col(c) for c in group]
    return small.select(*made, *small.columns[len(ids):])


def reduced(
    star, fact: str, parts: dict[str, Part], by: list[str], extra: list[str] | None = None,
    where: dict[str, Callable[[Column], Column]] | None = None, dates: tuple[int, int] | None = None,
) -> tuple[DataFrame | None, list[tuple[str, DataFrame]]]:
    """Additive parts per group, and per distinct part its groups with the key."""
    conditions = where or {}
    columns = list(dict.fromkeys([*by, *(extra or []), *conditions]))
    keys, own = group_columns(fact, columns)
    df = fact_table(star, fact)
    if dates is not None and "date_sk" in FACT_KEYS[fact]:
        df = df.filter(F.col("date_sk").between(*dates))
    group = [*keys, *own]

    def finish(small: DataFrame) -> DataFrame:
        wide = slice_by(star, small, columns)
        for c, test in conditions.items():
            wide = wide.filter(test(F.col(c)))
        return wide

    adding = {n: p for n, p in parts.items() if p.kind != "distinct"}
    additive = None
    if adding:
        sums = [F.sum(p.value()).alias(n) for n, p in adding.items()]
        additive = finish(_grouped(df, group, sums))
    distincts = []
    for n, p in parts.items():
        if p.kind == "distinct":
            rows = df if p.where is None else df.filter(p.where())
            distincts.append((n, finish(rows.select(*group, F.col(p.column).alias(n)).distinct())))
    return additive, distincts


def _kind(p: Part) -> str:
    return TOTAL if p.kind == "sum" and p.column not in ("quantity", "total_orders") else "bigint"


def evaluate(
    star, names: list[str], by: list[str] | tuple[str, ...] = (),
    where: dict[str, Callable[[Column], Column]] | None = None, dates: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per group with every measure asked for."""
    by = list(by)
    parts = parts_of(names)
    facts = dict.fromkeys(p.fact for p in parts.values())
    pieces = []
    for fact in facts:
        mine = {n: p for n, p in parts.items() if p.fact == fact}
        additive, distincts = reduced(star, fact, mine, by, where=where, dates=dates)
        if additive is not None:
            adding = [n for n, p in mine.items() if p.kind != "distinct"]
            pieces.append((adding, additive.groupBy(*by).agg(*[F.sum(f"`{n}`").alias(n) for n in adding])))
        for n, keyed in distincts:
            pieces.append(([n], keyed.groupBy(*by).agg(F.nullif(F.count_distinct(f"`{n}`"), F.lit(0)).alias(n))))
    stacked = None
    for mine, df in pieces:
        shaped = df.select(
            *by,
            *[(F.col(f"`{n}`") if n in mine else F.lit(None)).cast(_kind(p)).alias(n) for n, p in parts.items()],
        )
        stacked = shaped if stacked is None else stacked.unionByName(shaped)
    folded = stacked.groupBy(*by).agg(*[F.max(f"`{n}`").alias(n) for n in parts])
    return folded.select(*by, *formulas(names))
