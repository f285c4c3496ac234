"""Period-over-period change of any measure."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.keys import date_of_sk
from tallyhouse.functions.money import total_ratio
from tallyhouse.plans import days
from tallyhouse.plans.measures import MEASURES, fact_table, parts_of, reduced, slice_by, value
from tallyhouse.session import settle


def _month(a: Column) -> tuple[Column, Column]:
    return F.trunc(a, "MM"), F.last_day(a)


def _mom(a):
    before = F.add_months(F.trunc(a, "MM"), -1)
    return (*_month(a), before, F.last_day(before))


def _yoy(a):
    before = F.add_months(F.trunc(a, "MM"), -12)
    return (*_month(a), before, F.last_day(before))


def _to_date(unit: str, months: int) -> Callable:
    """From the start of the unit to the anchor, against the same span earlier."""

    def windows(a):
        end = F.add_months(a, -months)
        return F.trunc(a, unit), a, F.add_months(F.trunc(a, unit), -months), end

    return windows


def _days(n: int) -> Callable:
    return lambda a: (F.date_sub(a, n - 1), a, F.date_sub(a, 2 * n - 1), F.date_sub(a, n))


def _t12m(a):
    mid = F.add_months(a, -12)
    return F.date_add(mid, 1), a, F.date_add(F.add_months(a, -24), 1), mid


# kind -> (first, last, previous first, previous last) of an anchor date
WINDOWS: dict[str, Callable] = {
    "MoM": _mom,
    "YoY": _yoy,
    "MoM_MTD": _to_date("MM", 1),
    "YoY_MTD": _to_date("MM", 12),
    "QoQ": _to_date("QUARTER", 3),
    "YTD": _to_date("YEAR", 12),
    "YoY_YTD": _to_date("YEAR", 12),
    "WoW": _days(7),
    "DoD": _days(1),
    "T12M": _t12m,
}
SELECTED = ("PoP", "SPLY")      # windows set by a chosen range, not by an anchor


def _selected_windows(kind: str, first: Column, last: Column):
    if kind == "PoP":
        length = F.datediff(last, first) + 1
        return first, last, F.date_sub(first, length), F.date_sub(first, 1)
    return first, last, F.add_months(first, -12), F.add_months(last, -12)


def _daily(star, measure: str, by: list[str], dates: tuple[int, int] | None = None):
    """Parts per group and day, and per distinct part its keys per group and day."""
    parts = parts_of([measure])
    facts = dict.fromkeys(p.fact for p in parts.values())
    rows, keyed = None, []
    for fact in facts:
        mine = {n: p for n, p in parts.items() if p.fact == fact}
        additive, distincts = reduced(star, fact, mine, by, extra=["date_sk"], dates=dates)
        keyed += distincts
        if additive is not None:
            adding = [n for n, p in mine.items() if p.kind != "distinct"]
            flat = additive.groupBy(*by, "date_sk").agg(*[F.sum(f"`{n}`").alias(n) for n in adding])
            rows = flat if rows is None else rows.unionByName(flat, allowMissingColumns=True)
    return parts, rows, keyed


def _daily_seen(star, measure: str, by: list[str], dates: tuple[int, int] | None) -> tuple[dict, DataFrame]:
    """Parts per group and day, from the day summaries where they have the groups. Of
    distinct keys only whether there are any is right."""
    parts, rows = parts_of([measure]), None
    for fact in dict.fromkeys(p.fact for p in parts.values()):
        mine = {n: p for n, p in parts.items() if p.fact == fact}
        held = days.covering(star, fact, by)
        if held is not None:
            summary, keys = held
            if dates is not None:
                summary = summary.filter(F.col("date_sk").between(*dates))
            small = summary.groupBy(*dict.fromkeys([*keys, "date_sk"])).agg(*[F.sum(f"`{n}`").alias(n) for n in mine])
            found = [(list(mine), slice_by(star, small, by))]
        else:
            additive, distincts = reduced(star, fact, mine, by, extra=["date_sk"], dates=dates)
            found = [([n for n, p in mine.items() if p.kind != "distinct"], additive)] if additive is not None else []
            found += [([n], keyed.withColumn(n, F.when(F.col(f"`{n}`").isNotNull(), F.lit(1).cast("bigint")))) for n, keyed in distincts]
        for names, df in found:
            flat = df.groupBy(*by, "date_sk").agg(*[F.sum(f"`{n}`").alias(n) for n in names])
            rows = flat if rows is None else rows.unionByName(flat, allowMissingColumns=True)
    return parts, rows


def last_data_date(star, measure: str, by: list[str] | tuple[str, ...] = (), dates=None) -> DataFrame:
    """Latest day per group on which the measure is not blank.

    Read from the day summaries of the star, if it has them and they have the groups'
    keys; a star without, or a group by customer or product, reads the facts."""
    by = list(by)
    parts, rows = _daily_seen(star, measure, by, dates)
    folded = rows.groupBy(*by, "date_sk").agg(*[F.sum(f"`{n}`").alias(n) for n in parts])
    seen = folded.select(*by, date_of_sk("date_sk").alias("_day"), value(measure).alias("_value"))
    return seen.groupBy(*by).agg(F.max(F.when(F.col("_value").isNotNull(), F.col("_day"))).alias("last_data_date"))


def date_key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _last_day(star, measure: str, dates: tuple[int, int] | None) -> date | None:
    """Latest day on which the measure is not blank. Without day summaries it is looked for
    from the newest days back, in spans that grow eightfold, so old history is rarely read."""
    parts = parts_of([measure])
    if all(days.covering(star, p.fact, []) for p in parts.values()):
        return last_data_date(star, measure, (), dates).first()[0]
    facts = [fact_table(star, f) for f in dict.fromkeys(p.fact for p in parts.values())]
    ends = [f.agg(F.min("date_sk"), F.max("date_sk")).first() for f in facts]
    ends = [e for e in ends if e[0] is not None]
    if not ends:
        return None
    low, high = min(e[0] for e in ends), max(e[1] for e in ends)
    if dates is not None:
        low, high = max(low, dates[0]), min(high, dates[1])
    last, span = datetime.strptime(str(high), "%Y%m%d").date(), 31
    while low <= high:
        start = max(low, date_key(max(last - timedelta(span), date(1, 1, 1))))
        found = last_data_date(star, measure, (), (start, high)).first()
        if found is not None and found[0] is not None:
            return found[0]
        if start == low:
            break
        span *= 8
    return None


def _span(spark, windows: Callable, low: date, high: date) -> tuple[int, int]:
    """First and last date key any window of an anchor from ``low`` to ``high`` touches."""
    first, last = (windows(F.lit(d).cast("date")) for d in (low, high))
    row = spark.range(1).select(F.least(*first), F.greatest(*last)).first()
    return date_key(row[0]), date_key(row[1])


def period_delta(
    star, measure: str, kind: str, by: list[str] | tuple[str, ...] = (), selection: tuple[str, str] | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """Current value, previous value and ``(current - previous) / previous``.

    Both windows are filled by one conditional aggregation. The anchor is the last day
    with data in the selection, or ``as_of``; the windows themselves look beyond it. It
    is found first (one small row per group, from the day summaries), so the facts are
    read between literal dates only. A chosen range (``SELECTED``) gives the groups with data in its windows.
    """
    by = list(by)
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure}")
    spark = star.dim_date.sparkSession
    anchors = None
    if kind in SELECTED:
        if selection is None:
            raise ValueError(f"{kind} needs a selected date range")
        first, last = (F.lit(d).cast("date") for d in selection)

        def windows(_):
            return _selected_windows(kind, first, last)

        low = high = date.fromisoformat(selection[1])
    else:
        windows = WINDOWS[kind]
        chosen = None if selection is None else tuple(int(d.replace("-", "")) for d in selection)
        if as_of is not None:
            low = high = as_of
        elif by:
            anchors = settle(last_data_date(star, measure, by, chosen).withColumnRenamed("last_data_date", "_anchor"))
            low, high = anchors.agg(F.min("_anchor"), F.max("_anchor")).first()
        else:
            low = high = _last_day(star, measure, chosen)
    # Without any anchor no day is in a window, and no row is read.
    dates = (0, 0) if high is None else _span(spark, windows, low, high)
    parts, rows, keyed = _daily(star, measure, by, dates)

    def anchored(df: DataFrame) -> DataFrame:
        day = df.withColumn("_day", date_of_sk("date_sk"))
        if anchors is None:
            return day.withColumn("_anchor", F.lit(high).cast("date"))
        return day.join(renamed, _same(by))

    renamed = None if anchors is None else anchors.withColumnsRenamed({c: f"_by_{c}" for c in by})

    def halves(df: DataFrame, names: list[str], combine: Callable) -> DataFrame:
        lo, hi, plo, phi = windows(F.col("_anchor"))
        now, then = F.col("_day").between(lo, hi), F.col("_day").between(plo, phi)
        aggs = []
        for n in names:
            aggs.append(combine(F.when(now, F.col(f"`{n}`"))).alias(f"now_{n}"))
            aggs.append(combine(F.when(then, F.col(f"`{n}`"))).alias(f"then_{n}"))
        return anchored(df).groupBy(*by).agg(*aggs)

    pieces = []
    adding = [n for n, p in parts.items() if p.kind != "distinct"]
    if adding:
        pieces.append(halves(rows, adding, F.sum))
    for n, keys in keyed:
        counted = halves(keys, [n], lambda c: F.nullif(F.count_distinct(c), F.lit(0)))
        pieces.append(counted)
    stacked = None
    for piece in pieces:
        stacked = piece if stacked is None else stacked.unionByName(piece, allowMissingColumns=True)
    columns = [c for n in parts for c in (f"now_{n}", f"then_{n}")]
    folded = stacked.groupBy(*by).agg(*[F.max(f"`{c}`").alias(c) for c in columns])
    if anchors is not None:     # groups whose measure is blank on every day stay
        folded = renamed.join(folded, _same(by), "left").select(*[F.col(f"_by_{c}").alias(c) for c in by], *columns)

    both = folded.select(
        *by,
        value(measure, "now_").alias("current_value"),
        value(measure, "then_").alias("previous_value"),
    )
    if kind in SELECTED and by:
        both = both.filter(F.col("current_value").isNotNull() | F.col("previous_value").isNotNull())
    current = F.coalesce(F.col("current_value"), F.lit(0))
    return both.withColumn("delta", total_ratio(current - F.col("previous_value"), "previous_value"))


def _same(by: list[str]) -> Column:
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return on
