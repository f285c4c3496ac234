"""Set operations by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def union_named(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def set_diff(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, tagged with what is wrong."""
    missing = expected.select(key).distinct().join(actual, key, "left_anti")
    extra = actual.select(key).distinct().join(expected, key, "left_anti")
    return missing.withColumn("issue", F.lit("missing_from_seed")).unionByName(
        extra.withColumn("issue", F.lit("unexpected_in_seed"))
    )
