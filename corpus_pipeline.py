"""From raw documents to a training mix, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its rows are written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of
``documents`` (and any others that were there).

1. toxicity: texts scored 0.3 or more go.
2. line_dedup: repeated long lines go from the texts; ``n_chars`` follows. No row goes.
3. near_dedup: of each group of SimHash near-duplicates one row stays: that of the
   smallest id (null ids last); of equal rows one.
4. decontaminate: contaminated texts go.
5. mix: what the target weights take; columns ``size``, ``source_size``, ``target`` and
   ``taken`` are added (in place of columns of that name). Rows nothing is taken of go.
   Rows equal in id, text and source take equal parts of what they take together; the
   remainder, less than one word for each of them, is not taken.

Empty tables, null texts and ids and repeated rows are handled as the operators say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import free, prepare, same_key, table
from tallyhouse.llm.decontaminate import without_contaminated
from tallyhouse.llm.line_dedup import without_repeated_lines
from tallyhouse.llm.simhash import one_of_each_group
from tallyhouse.llm.source_mix import mixed_documents
from tallyhouse.llm.toxicity import without_toxic
from tallyhouse.session import shared_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    added = ["size", "source_size", "target", "taken"]
    taken = mixed_documents(docs, keep_key=True).filter("taken > 0")
    # Rows equal in id and text are told apart by nothing: each takes an even part of what
    # they take together.
    id_, h, source, n, total = free(docs, "__id", "__h", "__source", "__rows", "__sum")
    taken = taken.groupBy(F.col("doc_id").alias(id_), F.col("h").alias(h), F.col("source").alias(source)).agg(
        F.count("*").alias(n), F.sum("taken").alias(total), *[F.max(c).alias(c) for c in added[:3]])
    docs = docs.drop(*added)
    on = same_key(docs, id_, h) & F.col("source").cast("string").eqNullSafe(F.col(source))
    out = docs.join(taken.hint("shuffle_hash"), on)
    return out.withColumn("taken", F.floor(F.col(total) / F.col(n)).cast("long")).drop(id_, h, source, n, total)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: The label model and the flow can't be put into SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
