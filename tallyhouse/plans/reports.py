"""Report tables built on measures: curves, rankings, waterfalls, series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.clean import bears_revenue, tier
from tallyhouse.functions.keys import date_of_sk
from tallyhouse.functions.money import total_ratio
from tallyhouse.operators.aggregates import count_groups, group_median, repeat_share
from tallyhouse.operators.topk import percent_to_reach, top_name, top_percent
from tallyhouse.operators.windows import running_total, share_of
from tallyhouse.plans import days, distinct
from tallyhouse.plans.facts import ORDER
from tallyhouse.plans.measures import MEASURES, evaluate, slice_by
from tallyhouse.plans.period import date_key, period_delta
from tallyhouse.session import settle

# Bands and floors of the reports.
MARGIN_BOUNDS, MARGIN_LABELS = ["0.56", "0.53"], ["green", "sand"]
MAJOR_MARKET_REVENUE = 2000
MEDIAN_MARGIN_REVENUE = 100
HOME_MARKET = "United States"


def product_revenue(star) -> DataFrame:
    """Revenue per product name; names without revenue lines are not in it."""
    return evaluate(star, ["revenue"], ["product_name"]).filter(F.col("revenue").isNotNull())


def pareto(star) -> DataFrame:
    """Revenue per product name with the running total and its share, best first."""
    return running_total(product_revenue(star), "revenue", "cumulative_revenue", "cumulative_share")


def pareto_curve(star) -> DataFrame:
    return top_percent(product_revenue(star), "revenue")


def pareto_points(star) -> DataFrame:
    return percent_to_reach(product_revenue(star), "revenue", {"pct_at_50": 0.5, "pct_at_80": 0.8})


def revenue_share(star) -> DataFrame:
    return share_of(evaluate(star, ["revenue"], ["country_name"]), "revenue", [], "revenue_share")


def international_share(star, home: str = HOME_MARKET) -> DataFrame:
    """One minus the home market's share of revenue."""
    by_country = evaluate(star, ["revenue"], ["country_name"])
    at_home = F.sum(F.when(F.col("country_name") == home, F.col("revenue")))
    share = F.coalesce(total_ratio(at_home, F.sum("revenue")), F.lit(0))
    return by_country.agg((F.lit(1) - share).alias("international_share"))


def country_repeat(star) -> DataFrame:
    """Share of a country's paying customers with at least two paid orders."""
    paid = star.fact_order.filter(bears_revenue("status"))
    named = slice_by(star, paid.select("country_sk", "customer_sk"), ["country_name"])
    return repeat_share(named, "customer_sk", ["country_name"], 2, "country_repeat_rate")


def _product_lines(star) -> DataFrame:
    """Profit and net revenue per product name, reduced by product first."""
    return evaluate(star, ["product_profit", "product_net_revenue", "product_margin"], ["product_name"])


def median_margin(star, floor=MEDIAN_MARGIN_REVENUE, lines: DataFrame | None = None) -> DataFrame:
    return group_median(
        _product_lines(star) if lines is None else lines, "product_name", F.max("product_margin"), F.max("product_net_revenue") > floor,
        "median_margin",
    )


def margin_vs_median(star, floor=MEDIAN_MARGIN_REVENUE) -> DataFrame:
    """Points by which each product's margin differs from the median margin."""
    lines = settle(_product_lines(star))
    middle = median_margin(star, floor, lines).scalar()
    return lines.filter(F.col("product_margin").isNotNull()).withColumn("_median", middle).select(
        "product_name",
        "product_margin",
        F.round((F.col("product_margin") - F.col("_median")) * 100, 6).alias("points_vs_median"),
    )


def loss_making(star) -> DataFrame:
    return count_groups(_product_lines(star), "product_name", F.max("product_profit") < 0, "loss_making_designs")


def top_market(star) -> DataFrame:
    return top_name(evaluate(star, ["revenue"], ["country_name"]), "country_name", "revenue", "top_market_name")


def best_margin_market(star, floor=MAJOR_MARKET_REVENUE) -> DataFrame:
    markets = evaluate(star, ["revenue", "profit_margin"], ["country_name"])
    return top_name(markets, "country_name", "profit_margin", "best_margin_major_market", F.col("revenue") >= floor)


def margin_bands(star) -> DataFrame:
    markets = evaluate(star, ["profit_margin"], ["country_name"])
    bounds = [F.lit(b).cast("decimal(4,2)") for b in MARGIN_BOUNDS]
    return markets.withColumn("margin_band", tier(F.col("profit_margin"), bounds, MARGIN_LABELS, "red"))


def _unpivot(df: DataFrame, by: list[str], rows: list[tuple[str, Column]], label: str, name: str) -> DataFrame:
    """Columns to rows with their order; one pass, no join."""
    entries = F.array(
        *[
            F.struct(F.lit(text).alias(label), F.lit(i + 1).alias("step_order"), c.cast("decimal(28,6)").alias(name))
            for i, (text, c) in enumerate(rows)
        ]
    )
    return df.select(*by, F.explode(entries).alias("_e")).select(*by, "_e.*")


def bridge(star, by: list[str] | None = None) -> DataFrame:
    """Profit waterfall: what is added and what is taken off on the way to profit."""
    by = by or []
    m = evaluate(star, ["profit_base_net_revenue", "cogs", "design_fee", "payment_fee", "contribution_profit"], by)
    rows = [
        ("Net rev", F.col("profit_base_net_revenue")),
        ("COGS", -F.col("cogs")),
        ("Design", -F.col("design_fee")),
        ("Payment fee", -F.col("payment_fee")),
        ("Profit", F.col("contribution_profit")),
    ]
    return _unpivot(m, by, rows, "step", "bridge_value")


def cost_structure(star, by: list[str] | None = None) -> DataFrame:
    """Cost components, their total, and each as a share of net revenue."""
    by = by or []
    m = evaluate(star, ["cogs", "payment_fee", "design_fee", "total_cost", "profit_base_net_revenue"], by)
    base = F.col("profit_base_net_revenue")
    rows = [("COGS", "cogs"), ("Payment fee", "payment_fee"), ("Design fee", "design_fee"), ("Total", "total_cost")]
    entries = F.array(
        *[
            F.struct(
                F.lit(text).alias("cost_type"),
                F.lit(i + 1).alias("step_order"),
                F.col(c).cast("decimal(28,6)").alias("cost_value"),
                total_ratio(F.col(c), base).alias("cost_share"),
            )
            for i, (text, c) in enumerate(rows)
        ]
    )
    return m.select(*by, F.explode(entries).alias("_e")).select(*by, "_e.*")


# Metrics of the trend chart's selector and of the tooltip, in order.
TREND_METRICS = (
    ("Revenue", "profit_base_net_revenue"), ("Profit", "contribution_profit"), ("Orders", "paid_orders"), ("AOV", "aov"),
)
TOOLTIP_METRICS = (
    ("Revenue", "revenue"), ("Profit", "contribution_profit"), ("Margin", "profit_margin"), ("Paid orders", "paid_orders"),
)


def metric_rows(star, metrics, by: list[str]) -> DataFrame:
    """Long form: one row per group and metric, for a metric selector."""
    m = evaluate(star, [name for _, name in metrics], by)
    return _unpivot(m, by, [(text, F.col(name)) for text, name in metrics], "metric", "metric_value")


def last_order_day(star) -> date | None:
    """The day of the last order, whatever its status."""
    held = days.covering(star, "fact_order", [])
    return (held[0] if held else star.fact_order).agg(F.max(date_of_sk("date_sk"))).first()[0]


def growth_12_months(star) -> DataFrame:
    """Revenue of the last 12 months against the 12 before, as of the last order."""
    return period_delta(star, "revenue", "T12M", as_of=last_order_day(star))


def last_months(star, n: int = 8) -> DataFrame:
    """Revenue of the last ``n`` months up to the last order; empty months are zero."""
    last = last_order_day(star)
    one = star.dim_date.sparkSession.range(0 if last is None else 1).select(F.trunc(F.lit(last).cast("date"), "MM").alias("_last"))
    first = F.add_months("_last", -(n - 1))
    spine = one.select(F.explode(F.sequence(first, "_last", F.expr("interval 1 month"))).alias("month_start"))
    start = one.select(first).first()
    dates = (0, 0) if start is None else (date_key(start[0]), date_key(last))
    monthly = evaluate(star, ["revenue"], ["year", "month"], dates=dates).select(
        F.make_date("year", "month", F.lit(1)).alias("month_start"), "revenue"
    )
    return spine.join(monthly, "month_start", "left").select(
        "month_start", F.coalesce(F.col("revenue"), F.lit(0)).cast("decimal(28,6)").alias("revenue")
    )


CALENDAR = ["year", "quarter", "month", "day_of_month"]


def calendar_drill(star, names: list[str], depth: int = 3) -> DataFrame:
    """Measures at every level of year > quarter > month > day, from one day-level pass.

    Sums are rolled up; distinct counts are united as bitmaps from level to level. Ratios
    need ``evaluate`` at each level.
    """
    adding, keyed = [], []
    for name in names:
        parts = MEASURES[name].parts
        if len(parts) != 1 or name not in parts:
            raise ValueError(f"{name} does not add up over dates")
        (keyed if parts[name].kind == "distinct" else adding).append(name)
    levels = CALENDAR[:depth]
    pieces = [distinct.drill(star, name, levels) for name in keyed]
    if adding:
        rolled = evaluate(star, adding, levels).rollup(*levels).agg(
            F.grouping_id().alias("_gid"), *[F.sum(n).cast("decimal(28,6)").alias(n) for n in adding]
        )
        pieces.append(rolled.withColumn("level", F.lit(len(levels)) - F.bit_count("_gid")).drop("_gid"))
    if len(pieces) == 1:
        return pieces[0]
    stacked = pieces[0]
    for piece in pieces[1:]:
        stacked = stacked.unionByName(piece, allowMissingColumns=True)
    return stacked.groupBy(*levels, "level").agg(*[F.max(n).alias(n) for n in names])


# Every measure that needs no group, for the one-row overview.
OVERVIEW = [n for n in MEASURES]


def overview(star) -> DataFrame:
    return evaluate(star, OVERVIEW)


def revenue_in_scope(star, orders: DataFrame) -> DataFrame:
    """Revenue of the lines whose order is in scope."""
    lines = star.fact_order_item.filter("is_revenue_status").join(orders.select(*ORDER), ORDER, "left_semi")
    return lines.agg(F.sum("line_revenue_usd").cast("decimal(28,6)").alias("revenue"))
