"""Helpers shared by the training-data operators.

Rows of ``documents`` are identified by ``(doc_id, h)``, ``h`` the hash of the text:
a missing or repeated ``doc_id`` then never mixes the findings of different texts, and
equal rows share their findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import settle, tune

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
#: What stands between words: all ASCII that is no digit and no lower-case letter.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between tokens: ASCII blanks.
BLANK_RUN = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for these jobs: Arrow batches stay small even with long texts."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone. Pure ASCII texts take the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``h``; other columns are left behind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))


def words_of(text: Column) -> Column:
    """The words of a text, lower-cased in A-Z, in order."""
    return F.filter(F.split(lower_ascii(text), GAP), lambda w: w != "")


def n_words_of(text: Column) -> Column:
    """How many words a text has, without cutting it up."""
    return F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")


def free(docs: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened where ``docs`` has such a column already."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def same_key(docs: DataFrame, doc_id: str, h: str) -> Column:
    """``docs`` (as given, with ``text``) against key columns of another table."""
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & (own == F.col(h))


def with_findings(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Left join on ``(doc_id, h)``; ``found`` has one row per key."""
    found = found.withColumnsRenamed({"doc_id": "__id", "h": "__h"})
    on = docs["doc_id"].eqNullSafe(found["__id"]) & (docs["h"] == found["__h"])
    return docs.join(found.hint("shuffle_hash"), on, "left").drop("__id", "__h")


#: A key is hot if it has more than one of so many parts of all rows; at most so many keys are.
HOT = 1000


def join_hot(rows: DataFrame, groups: DataFrame, key: str, n: str, by: list[str]) -> DataFrame:
    """Inner join of ``rows`` with one row of ``groups`` per ``key``, which has ``n`` of them,
    told apart by the columns ``by``.

    The rows of hot keys are dealt out over as many salts as they have parts, so that none
    of them meets in one task, however few its bytes. At most ``HOT`` keys can be hot: only
    hashes of those are broadcast."""
    total = groups.agg(F.sum(n)).first()[0] or 0
    salts = F.ceil(F.col(n) * HOT / F.lit(max(total, 1))).cast("int")
    groups = groups.withColumn("__salts", salts)
    hot = groups.filter(F.col("__salts") > 1).groupBy(F.xxhash64(key).alias("__hash")).agg(F.max("__salts").alias("__salts"))
    marked = rows.withColumn("__hash", F.xxhash64(key)).join(F.broadcast(hot), "__hash", "left")
    spread = F.pmod(F.xxhash64(*by), F.coalesce("__salts", F.lit(1)))
    marked = marked.withColumn("__salt", spread.cast("int")).drop("__hash", "__salts")
    # Two keys of one hash share their salts: each is there under all of them.
    both = groups.withColumn("__hash", F.xxhash64(key)).drop("__salts").join(F.broadcast(hot), "__hash", "left")
    both = both.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__hash", "__salts")
    return marked.join(both, [key, "__salt"]).drop("__salt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


__all__ = ["BLANKS", "BLANK_RUN", "GAP", "free", "join_hot", "lower_ascii", "n_words_of", "prepare", "same_key", "settle", "table", "texts", "with_findings", "words_of"]
