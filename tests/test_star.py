"""Measures, periods, quality and plan shapes over the published star."""

import os
from datetime import date, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import days, quality
from tallyhouse.plans.dims import dim_date
from tallyhouse.plans.measures import evaluate
from tallyhouse.plans.period import WINDOWS, last_data_date, period_delta
from tallyhouse.plans.reports import growth_12_months, last_order_day
from tallyhouse.plans.staging import stg_order_items, stg_orders
from tallyhouse.plans.warehouse import _write
from tallyhouse.sources.seeds import country_map


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_calendar(spark):
    df = dim_date(spark)
    assert df.count() == 4018
    row = df.filter("date_sk = 20240229").first()
    assert (row.quarter, row.month_name, row.iso_day_of_week, row.day_name, row.is_weekend) == (1, "Feb", 4, "Thu", False)


def test_country_seed(spark):
    df = country_map(spark)
    assert df.count() == 62
    assert df.filter("country_code = 'GB'").count() == 2


def test_every_declared_rule_holds(star):
    broken = quality.run_suite(star).filter("violations > 0").collect()
    assert broken == []


def test_suite_finds_violations(star, spark):
    class Broken:
        def __getattr__(self, name):
            df = getattr(star, name)
            if name == "fact_refund":
                return df.unionByName(df).withColumn("order_sk", F.lit("nowhere")).withColumn("event_type", F.lit("gift"))
            return df

    found = {r.rule: r.violations for r in quality.suite_of(Broken(), "fact_refund").filter("violations > 0").collect()}
    assert set(found) == {"accepted event_type", "unique refund_sk", "order_sk in fact_order"}
    assert found["order_sk in fact_order"] == 1


def test_unreachable_attribute(star):
    with pytest.raises(ValueError):
        evaluate(star, ["revenue"], ["segment"])


def test_where_and_dates(star):
    whole = evaluate(star, ["order_attempts"], ["year"]).filter("year = 1998").first().order_attempts
    assert evaluate(star, ["order_attempts"], dates=(19980101, 19981231)).first().order_attempts == whole
    assert evaluate(star, ["order_attempts"], where={"year": lambda c: c == 1998}).first().order_attempts == whole


def test_blank_measures(star):
    none = evaluate(star, ["revenue", "net_revenue", "refund_rate", "one_time_share"], where=None, dates=(20300101, 20300102)).first()
    assert (none.revenue, none.net_revenue, none.refund_rate) == (None, None, None)


def windows_of(spark, kind, anchor):
    cols = WINDOWS[kind](F.lit(anchor).cast("date"))
    return tuple(str(x) for x in spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


@pytest.mark.parametrize(
    "kind, anchor, want",
    [
        ("MoM", "2024-03-15", ("2024-03-01", "2024-03-31", "2024-02-01", "2024-02-29")),
        ("YoY", "2024-02-10", ("2024-02-01", "2024-02-29", "2023-02-01", "2023-02-28")),
        ("MoM_MTD", "2024-03-31", ("2024-03-01", "2024-03-31", "2024-02-01", "2024-02-29")),
        ("YoY_MTD", "2024-02-29", ("2024-02-01", "2024-02-29", "2023-02-01", "2023-02-28")),
        ("QoQ", "2024-05-31", ("2024-04-01", "2024-05-31", "2024-01-01", "2024-02-29")),
        ("YTD", "2024-02-29", ("2024-01-01", "2024-02-29", "2023-01-01", "2023-02-28")),
        ("WoW", "2024-03-10", ("2024-03-04", "2024-03-10", "2024-02-26", "2024-03-03")),
        ("DoD", "2024-03-01", ("2024-03-01", "2024-03-01", "2024-02-29", "2024-02-29")),
        ("T12M", "2024-02-29", ("2023-03-01", "2024-02-29", "2022-03-01", "2023-02-28")),
    ],
)
def test_windows(spark, kind, anchor, want):
    assert windows_of(spark, kind, anchor) == want


def test_period_needs_what_it_needs(star):
    with pytest.raises(ValueError):
        period_delta(star, "revenue", "PoP")
    with pytest.raises(ValueError):
        period_delta(star, "nothing", "MoM")


@pytest.mark.parametrize("kind", [*WINDOWS, "PoP", "SPLY"])
@pytest.mark.parametrize("measure, by", [("revenue", []), ("revenue", ["country_name"]), ("paid_orders", [])])
def test_periods_read_a_date_range(star, kind, measure, by):
    chosen = ("1998-02-10", "1998-05-20") if kind in ("PoP", "SPLY") else None
    shown = plan(period_delta(star, measure, kind, by, chosen))
    pushed = [line for line in shown.splitlines() if "PushedFilters" in line and "date_sk" in line]
    assert pushed and all("GreaterThanOrEqual(date_sk," in line and "LessThanOrEqual(date_sk," in line for line in pushed)


@pytest.mark.parametrize("kind, by", [("MoM", ["country_name"]), ("WoW", ["site_code"]), ("DoD", [])])
def test_no_job_reads_the_history(star, spark, tmp_path, kind, by):
    """Days outside the windows lie in files that can't be read."""
    want = sorted(map(tuple, period_delta(star, "revenue", kind, by).collect()), key=str)
    ends = last_data_date(star, "revenue", by).agg(F.min("last_data_date"), F.max("last_data_date")).first()
    low = ends[0].replace(day=1) - timedelta(70)
    path, fact = str(tmp_path / "fact"), star.fact_order_item
    fact.withColumn("old", F.col("date_sk") < low.year * 10000 + low.month * 100 + low.day).write.partitionBy("old", "date_sk").parquet(path)
    broken = 0
    for file in (tmp_path / "fact" / "old=true").rglob("*.parquet"):
        file.write_bytes(b"no parquet")
        broken += 1
    for crc in (tmp_path / "fact" / "old=true").rglob("*.crc"):
        crc.write_bytes(b"")
    own = spark.read.schema(fact.schema).parquet(path)
    with pytest.raises(Exception):
        own.agg(F.sum("line_revenue_usd")).collect()
    other = SimpleNamespace(**{n: getattr(star, n) for n in ("dim_date", "dim_country", "dim_site", "days")}, fact_order_item=own)
    assert broken > 100
    assert sorted(map(tuple, period_delta(other, "revenue", kind, by).collect()), key=str) == want


def test_anchors_with_and_without_summaries(star):
    plain = SimpleNamespace(**{n: getattr(star, n) for n in ("dim_date", "dim_country", "dim_site", "dim_payment_method", *days.FACTS)})
    for measure, by in (("aov", ["country_name"]), ("refund_rate", ["site_code", "region"]), ("distinct_products_sold", ["method_code"]), ("cancelled_orders", [])):
        got, want = (sorted(map(tuple, last_data_date(s, measure, by).filter("last_data_date is not null").collect()), key=str) for s in (star, plain))
        assert got == want and got


def test_rules_are_counted_while_tables_are_written(star):
    shown = plan(quality._counted(star, "fact_order_item"))
    assert "row_rules" in shown and "fact_order_item/" not in shown
    seen = {(r.model, r.rule): r.violations for r in star.row_rules.collect()}
    assert seen["fact_order_item", quality.ROWS] == star.fact_order_item.count() and seen["stg_orders", quality.ROWS] == star.stg_orders.count()
    assert {m for m, _ in seen} >= {"fact_order", "fact_refund", "mart_order_profit", "dim_date"}


def test_broken_rows_are_counted_on_write(star, rows, tmp_path):
    df = rows([(1, 5), (2, None), (3, -1)], "k int, v int")
    found = _write(df, str(tmp_path / "t"), {"not_null v": F.col("v").isNotNull(), "v >= 0": F.col("v") >= 0})
    assert found == {"rows": 3, "not_null v": 1, "v >= 0": 1}


def test_growth_is_anchored_on_the_last_order(star, run):
    """Cancelled orders only on the last day: no revenue there, yet the window ends there."""
    last = star.fact_order.agg(F.max("date_sk")).first()[0]
    late = date(last // 10000, last // 100 % 100, last % 100) + timedelta(20)
    more = star.fact_order.limit(1).withColumns({"date_sk": F.lit(late.year * 10000 + late.month * 100 + late.day), "status": F.lit("cancelled")})
    other = SimpleNamespace(**{n: getattr(star, n) for n in ("fact_order_item", "dim_date")}, fact_order=star.fact_order.unionByName(more))
    assert last_order_day(other) == late
    want = period_delta(star, "revenue", "T12M", as_of=late).first()
    assert growth_12_months(other).first() == want
    assert want.current_value != growth_12_months(star).first().current_value


def test_previous_window_empty_gives_null(star):
    first = star.fact_order.agg(F.min("date_sk")).first()[0]
    day = date(first // 10000, first // 100 % 100, first % 100).isoformat()
    row = period_delta(star, "revenue", "YTD", selection=(day, day)).first()
    assert row.delta is None


# --- plans -------------------------------------------------------------------


def test_staging_does_not_shuffle(run, spark, tmp_path):
    run.wh.inputs.orders.limit(50).write.parquet(str(tmp_path / "o"))
    run.wh.inputs.order_items.limit(50).write.parquet(str(tmp_path / "i"))
    for df in (stg_orders(spark.read.parquet(str(tmp_path / "o")), "x"), stg_order_items(spark.read.parquet(str(tmp_path / "i")))):
        assert "Exchange" not in plan(df)


def test_date_range_reaches_the_scan(star):
    shown = plan(evaluate(star, ["revenue"], ["country_name"], dates=(19980101, 19981231)))
    assert "GreaterThanOrEqual(date_sk,19980101)" in shown and "LessThanOrEqual(date_sk,19981231)" in shown


def test_scan_reads_only_what_is_asked(star):
    shown = plan(evaluate(star, ["revenue"], ["country_name"]))
    read = shown.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in read.split(",") if ":" in c} <= {"country_sk", "line_revenue_usd", "is_revenue_status", "decimal(18"}


def test_no_cross_join_and_no_python_in_any_model(run):
    for name in ("fact_order", "fact_order_item", "fact_refund", "fact_order_cost", "mart_order_profit", "mart_product_profit", "mart_customer_summary"):
        shown = plan(run.model(name))
        assert "CartesianProduct" not in shown and "NestedLoop" not in shown and "Python" not in shown and "Pandas" not in shown


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) > 180
    assert os.path.exists("/root/testdata/sf0.001")


# --- distinct keys ------------------------------------------------------------


def test_numbers_are_dense_and_stay(spark, rows):
    from tallyhouse.plans.distinct import number_keys

    some = rows([(f"k{i % 700}",) for i in range(2000)] + [(None,)], "k string")
    first = number_keys(some, "k")
    assert sorted(r.number for r in first.collect()) == list(range(1, 701))
    more = number_keys(rows([(f"k{i}",) for i in range(650, 900)], "k string"), "k", first)
    held = {r.k: r.number for r in more.collect()}
    assert sorted(held.values()) == list(range(1, 901)) and all(held[r.k] == r.number for r in first.collect())
    assert number_keys(some.filter("k is null"), "k").count() == 0


def test_bitmaps_over_several_buckets(spark):
    from tallyhouse.plans import distinct

    df = spark.range(200_000).select((F.col("id") % 90_000).alias("key"), (F.col("id") % 3).alias("date_sk"))
    maps = distinct.bitmaps(df, "key", distinct.number_keys(df, "key"), ["date_sk"])
    assert maps.select("bucket").distinct().count() == 3
    got = {r.date_sk: r.n for r in distinct.counted(maps, ["date_sk"], "n").collect()}
    assert got == {r.date_sk: r.n for r in df.groupBy("date_sk").agg(F.count_distinct("key").alias("n")).collect()}
    assert distinct.between(maps, 0, 1, "n").first().n == df.filter("date_sk < 2").select("key").distinct().count()
    assert distinct.between(maps, 7, 9, "n").first().n is None


def test_drill_of_a_ratio_is_refused(star):
    from tallyhouse.plans.reports import calendar_drill

    with pytest.raises(ValueError):
        calendar_drill(star, ["aov"])
