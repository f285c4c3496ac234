"""All matches of a pattern with their places, in built-in functions only.

Spark returns matches without places. Splitting the text by the same pattern gives what
stands between them; the lengths of both, added up, give the places. Long match lists are
added up in blocks, so the work stays near-linear in their number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 128

_SPAN = "array<struct<start:bigint,end:bigint,value:string,before:string>>"


def running(values: Column, zero: int = 0, merge=lambda acc, x: acc + x) -> Column:
    """What all elements before each element of a non-empty array come to, merged (their sum)."""
    first = F.lit(zero).cast("long")

    # Values and the totals of blocks are computed once per row: as elements a transform runs over.
    def scanned(values: Column) -> Column:
        def total(start: Column, n: Column) -> Column:
            return F.aggregate(F.slice(values, start, n), first, merge)

        def each(totals: Column) -> Column:
            return F.transform(values, lambda x, i: merge(
                F.get(totals, F.floor(i / BLOCK).cast("int")), total(F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)))

        blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
        totals = F.aggregate(blocks, F.array(first), lambda acc, b: F.concat(acc, F.array(merge(F.element_at(acc, -1), total(b * BLOCK + 1, F.lit(BLOCK))))))
        return F.flatten(F.transform(F.array(totals), each))

    return F.flatten(F.transform(F.array(values), scanned))


def matches(text: Column, pattern: str, when: Column | None = None, context: int = 0) -> Column:
    """``start``, ``end`` (code points, end exclusive), ``value`` and ``before`` (the last
    ``context`` code points between this match and the one before it) of all leftmost
    non-overlapping matches. No match may be empty. ``when`` is a cheap test that holds
    wherever there is a match."""
    none = F.array().cast(_SPAN)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    both = F.zip_with(found, between, lambda m, s: F.struct(
        m.alias("m"), (F.right(s, F.lit(context)) if context else F.lit("")).alias("s"), F.length(s).cast("long").alias("gap"), F.length(m).cast("long").alias("n")))
    both = F.filter(both, lambda p: p["m"].isNotNull())   # after the last match stands one more piece

    def placed(pairs: Column) -> Column:
        sums = running(F.transform(pairs, lambda p: p["gap"] + p["n"]))
        return F.zip_with(pairs, sums, lambda p, before: F.struct(
            (before + p["gap"]).alias("start"), (before + p["gap"] + p["n"]).alias("end"), p["m"].alias("value"), p["s"].alias("before")))

    # As above: the pairs are computed once, as the element of a one-element array.
    out = F.flatten(F.transform(F.array(both), lambda pairs: F.when(F.size(pairs) > 0, placed(pairs)).otherwise(none)))
    return F.when(when, out).otherwise(none) if when is not None else out


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans in their order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, kind: str, order: int) -> Column:
    """Spans as ``start``, ``order``, ``end``, ``kind``, ``value``: they sort as they are listed."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")))
