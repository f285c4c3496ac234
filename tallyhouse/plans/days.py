"""Facts summed by day: small tables that answer when a measure last had data.

A summary has one row per day, site, country and payment method, with every part a measure
may be built from: sums and counts, and for distinct keys how many rows have one. Its size
follows the calendar, not the sales. Sums are mergeable: a batch of new fact rows appends
its own partial sums, a repeated batch overwrites them, and readers add the batches up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.money import TOTAL
from tallyhouse.plans.measures import FACT_KEYS, PARTS, Part, group_columns
from tallyhouse.sources.loads import BATCH, append_batch

KEYS = ("date_sk", "site_sk", "country_sk", "payment_method_sk")
FACTS = tuple(fact for fact in dict.fromkeys(p.fact for p in PARTS.values()) if set(KEYS) <= set(FACT_KEYS[fact]))


def _parts(fact: str) -> dict[str, Part]:
    return {n: p for n, p in PARTS.items() if p.fact == fact}


def _typed(fact: str, sums) -> list:
    kinds = {n: TOTAL if p.kind == "sum" and p.column != "quantity" else "bigint" for n, p in _parts(fact).items()}
    return [sums(n).cast(kind).alias(n) for n, kind in kinds.items()]


def summed(df: DataFrame, fact: str) -> DataFrame:
    """The fact's parts by ``KEYS``; a part without a value is NULL."""
    parts = _parts(fact)

    def of(n: str):
        p = parts[n]
        if p.kind != "distinct":
            return F.sum(p.value())
        return F.nullif(F.count(p.value()), F.lit(0))

    return df.groupBy(*KEYS).agg(*_typed(fact, of))


def append(rows: DataFrame, fact: str, path: str, batch_id: int) -> None:
    """Add a batch of fact rows to the summary; the same batch again changes nothing."""
    append_batch(summed(rows, fact), path, batch_id)


def _added(rows: DataFrame, fact: str) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*_typed(fact, lambda n: F.sum(f"`{n}`")))


def read(spark: SparkSession, fact: str, path: str) -> DataFrame:
    """The summary over all batches."""
    return _added(spark.read.option("basePath", path).parquet(path).drop(BATCH), fact)


def compact(spark: SparkSession, fact: str, path: str, target: str) -> None:
    """All batches so far as the first of a new folder; later ones are appended to that."""
    append_batch(read(spark, fact, path), target, 0)


def covering(star, fact: str, by: list[str]) -> tuple[DataFrame, list[str]] | None:
    """The fact's summary and the keys that serve ``by``, if it has them."""
    held = getattr(star, "days", None) or {}
    keys, own = group_columns(fact, by)
    return (held[fact], keys) if fact in held and not own and set(keys) <= set(KEYS) else None
