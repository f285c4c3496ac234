"""Distributed operators against brute force, with hot keys and ties."""

import random
import statistics
from datetime import date, timedelta
from decimal import Decimal as D

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import aggregates, checks, joins, setops, topk, windows


def test_ffill_like_pandas_over_many_blocks(spark):
    """One key holds two thirds of the rows and rates many blocks."""
    n = 3000
    pdf = pd.DataFrame({"row": range(n)})
    pdf["key"] = ["hot" if i % 3 else f"k{i % 50}" for i in pdf["row"]]
    pdf["a"] = [f"v{i}" if i % 97 == 0 else ("  " if i % 2 else "") for i in pdf["row"]]
    pdf["b"] = [i if i % 400 == 1 else None for i in pdf["row"]]
    df = spark.createDataFrame(pdf.astype({"b": "float"}), "row bigint, key string, a string, b double").withColumn("b", F.nanvl("b", F.lit(None)))
    got = windows.ffill(df, ["key"], "row", ["a", "b"], blank=r"^\s*$", block_bits=5).orderBy("row").toPandas()
    masked = pdf[["a", "b"]].replace(r"^\s*$", None, regex=True)
    want = masked.groupby(pdf["key"]).ffill()
    for c in ("a", "b"):
        assert [None if pd.isna(x) else x for x in got[c]] == [None if pd.isna(x) else x for x in want[c]]


def products(spark, values):
    return spark.createDataFrame([(f"p{i}", D(v)) for i, v in enumerate(values)], "name string, x decimal(18,6)")


VALUES = [100] * 40 + [i * 7 % 91 for i in range(60)] + [0, 0, -5]


def test_running_total_with_ties(spark):
    got = {r.name: r.cum for r in windows.running_total(products(spark, VALUES), "x", "cum", "share").collect()}
    assert got == {f"p{i}": D(sum(w for w in VALUES if w >= v)) for i, v in enumerate(VALUES)}


def test_ranges_follow_the_data(spark, monkeypatch):
    monkeypatch.setattr(windows, "BLOCK_RANGES", 4)
    for n in (10, 4000):
        df = spark.range(n).select((F.col("id") % 997 + F.lit(0)).cast("decimal(18,6)").alias("x"))
        found = windows.levels(df, "x", range_rows=50)
        ranges = -(-min(n, 997) // 50)
        assert found.count() == min(n, 997)
        values = sorted((int(v) % 997 for v in range(n)), reverse=True)
        above, rank = {}, {}
        for i, v in enumerate(values):
            rank.setdefault(v, i + 1)
            above[v] = sum(values[: i + 1])
        assert {int(r.x): (r["rank"], int(r.cum)) for r in found.collect()} == {v: (rank[v], above[v]) for v in rank}
        dealt = [p for p in found.inputFiles() if "settled" in p]
        assert ranges // 2 <= len(set(dealt)) <= ranges


def test_levels_rank(spark):
    got = {int(r.x): r["rank"] for r in windows.levels(products(spark, VALUES), "x").collect()}
    assert got == {v: 1 + sum(w > v for w in VALUES) for v in set(VALUES)}


def test_top_percent_includes_ties(spark):
    values = [v for v in VALUES if v > 0]
    got = {r.percent: r.cum_share for r in topk.top_percent(products(spark, values), "x").collect()}
    ranked, total = sorted(values, reverse=True), sum(values)
    for p in range(1, 101):
        k = -(-len(values) * p // 100)
        want = sum(v for v in values if v >= ranked[k - 1]) / total
        assert float(got[p]) == pytest.approx(want, abs=1e-9)
    first = topk.percent_to_reach(products(spark, values), "x", {"half": 0.5, "most": 0.8}).first()
    assert first.half == min(p for p in got if got[p] >= D("0.5"))
    assert first.most == min(p for p in got if got[p] >= D("0.8"))


def test_top_n_and_name(spark):
    df = products(spark, [5, 9, 9, 3])
    assert sorted(r.name for r in topk.top_n(df, "x", 1).collect()) == ["p1", "p2"]
    assert topk.top_name(df, "name", "x", "best").first().best == "p2"
    assert topk.top_name(df, "name", "x", "best", F.col("x") < 9).first().best == "p0"


def test_share_of(spark):
    df = spark.createDataFrame([("a", D(1)), ("a", D(3)), ("b", D(0))], "k string, x decimal(18,6)")
    got = sorted((r.k, r.s) for r in windows.share_of(df, "x", ["k"], "s").collect() if r.s is not None)
    assert got == [("a", D("0.25")), ("a", D("0.75"))]
    assert sum(r.s for r in windows.share_of(df, "x", [], "s").collect()) == 1


def test_daily_fx_fills_to_the_next_quote(spark):
    quotes = spark.createDataFrame([("2024-01-30", "gbp", 1.2), ("2024-02-02", "gbp", 1.3), ("2024-02-01", "gbp", None)], "d string, currency string, r double")
    quotes = quotes.select(F.col("d").cast("date").alias("rate_date"), "currency", F.col("r").cast("decimal(18,10)").alias("usd_rate"))
    got = {str(r.rate_date): float(r.usd_rate) for r in windows.daily_fx(quotes, F.lit("2024-02-03").cast("date")).collect()}
    assert got == {"2024-01-30": 1.2, "2024-01-31": 1.2, "2024-02-01": 1.2, "2024-02-02": 1.3, "2024-02-03": 1.3}


def test_missing_rate_counts_as_one(spark):
    df = spark.sql("select 'EUR' as ccy, date'2024-01-01' as day, cast(10 as decimal(18,6)) as x union all select 'USD', date'2024-01-01', 10")
    fx = spark.sql("select 'EUR' as currency, date'2024-01-01' as rate_date, cast(1.5 as decimal(18,10)) as usd_rate")
    rates = joins.rates_by_currency(fx, F.lit("2024-01-01"))
    assert sorted(r.usd for r in joins.fx_convert(df, rates, "ccy", "day", {"usd": "x"}).collect()) == [10, 15]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 8, 61])
def test_rates_by_day_equal_the_daily_table(spark, n):
    """Every day from before the first quote to after the last, in any number of quotes."""
    rng = random.Random(n)
    first, until = date(2024, 1, 10), date(2024, 9, 1)
    days = rng.sample(range(200), n)
    quotes = [(first + timedelta(d), ccy, D(rng.randint(1, 99))) for d in days for ccy in ("gbp", "EUR") if ccy == "EUR" or d % 2]
    quotes += [(first, "cad", None), (None, "cad", D(1)), (first, None, D(1))]
    quotes = spark.createDataFrame(quotes, "rate_date date, currency string, usd_rate decimal(18,10)")
    asked = [(ccy, first + timedelta(d)) for d in range(-3, 260) for ccy in ("GBP", "EUR", "CAD", None)] + [("EUR", None), ("XXX", first)]
    asked = spark.createDataFrame(asked, "ccy string, day date")
    daily = windows.daily_fx(quotes.filter("rate_date is not null"), F.lit(until))
    want = asked.join(daily, (F.col("ccy") == F.col("currency")) & (F.col("day") == F.col("rate_date")), "left").select("ccy", "day", "usd_rate")
    got = joins.with_rate(asked, joins.rates_by_currency(quotes, F.lit(until)), "ccy", "day", "usd_rate")
    key = lambda rows: sorted(map(str, rows.collect()))
    assert key(got) == key(want)


def test_rates_stay_a_row_a_currency(spark):
    """Of several quotes of a day the larger counts; a column named like the rate is replaced."""
    quotes = spark.sql("select date'2024-01-01' as rate_date, 'eur' as currency, cast(r as decimal(18,10)) as usd_rate from values (1.5), (1.7), (1.6) v(r)")
    rates = joins.rates_by_currency(quotes.unionByName(quotes.withColumn("currency", F.lit("Eur"))), F.lit("2030-01-01"))
    assert [(r.currency, r.first_day, len(r.rates), set(r.rates)) for r in rates.collect()] == [("EUR", date(2024, 1, 1), 2193, {D("1.7")})]
    df = spark.sql("select 'EUR' as ccy, date'2029-05-05' as day, 1 as rate")
    assert [(r.ccy, r.rate) for r in joins.with_rate(df, rates, "ccy", "day", "rate").collect()] == [("EUR", D("1.7"))]


def test_two_active_fee_rows_of_a_method_fail(spark):
    fees = spark.sql("select 'card' as payment_method, 0.01 as fee_percent, 0.3 as fixed_fee_usd union all select 'cash', 0, 0")
    orders = spark.sql("select 1 as k, 'card' as payment_method union all select 2, null")
    assert sorted((r.k, r.fixed_fee_usd is not None) for r in joins.with_fee_seed(orders, fees).collect()) == [(1, True), (2, False)]
    with pytest.raises(Exception, match="several active fee rows for card"):
        joins.with_fee_seed(orders, fees.unionAll(fees)).collect()


def test_median_without_a_percentile(spark):
    for values in ([4], [1, 9], [5, 5, 1, 7], [3, 1, 2, 2, 2], list(range(100, 0, -3))):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v int")
        out = aggregates.group_median(df, "k", F.max("v"), F.lit(True), "m")
        assert out.first()[0] == statistics.median(values)
        assert " percentile(" not in out._jdf.queryExecution().toString()
    assert aggregates.group_median(df, "k", F.max("v"), F.max("v") > 1000, "m").first()[0] is None


def test_nulls_last_and_medians(spark):
    df = spark.sql("select 'a' as k, cast(null as date) as d, 'x' as v union all select 'a', date'2024-01-02', 'y'")
    order = F.struct(*aggregates.nulls_last("d"))
    assert aggregates.first_per_key(df, ["k"], order).first().v == "y"
    nums = spark.createDataFrame([("a", 1), ("b", 2), ("b", 4), ("c", 9)], "k string, x int")
    assert aggregates.group_median(nums, "k", F.sum("x"), F.sum("x") > 1, "m").first().m == 7.5


def test_total_row_is_told_from_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    got = {(r.k, r.n) for r in aggregates.with_total(df, "k", [F.count(F.lit(1)).alias("n")]).collect()}
    assert got == {("a", 1), (None, 1), ("__ALL__", 2)}


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], "k int, v string")
    assert checks.check_not_null(df, "k").count() == 1
    assert [r.k for r in checks.check_unique(df, ["k"]).collect()] == [1]
    assert [r.v for r in checks.check_accepted_values(df, "v", ["a"]).collect()] == ["b"]
    assert checks.check_expression(df, F.col("k") > 5).count() == 2
    assert checks.check_relationship(df, "k", spark.range(1).select(F.col("id").cast("int").alias("k")), "k").count() == 1
    assert checks.check_equal_rowcount(df, df).isEmpty()
    assert checks.check_between(df, "k", 2, where=F.col("v") == "a").count() == 1
    table = {r.rule: r.violations for r in checks.check_table(df, {"k": F.col("k").isNotNull(), "v": F.col("v") == "a"}).collect()}
    assert table == {"k": 1, "v": 1}
    assert checks.fails(checks.check_not_null(df, "k"), "warn") == "warn"


def test_set_difference(spark):
    a = spark.createDataFrame([("x",), ("y",)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    assert sorted((r.k, r.issue) for r in setops.set_diff(a, b, "k").collect()) == [("x", "missing_from_seed"), ("z", "unexpected_in_seed")]


def test_settled_tables_are_dropped_by_their_owner(spark, monkeypatch):
    from tallyhouse import session

    monkeypatch.setattr(session, "_settled", [])
    kept = session.settle(spark.range(5))
    (path,) = session._settled
    assert kept.count() == 5 and session.drop_settled(spark) == 1
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
