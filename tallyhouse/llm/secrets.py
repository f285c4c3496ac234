"""Secret scans with corpus-wide ownership frequency, in DataFrame operations only.

Candidates of every text (assignments, access keys, hex runs) are found by pattern. The
hash of each candidate's value is aggregated over the corpus by distinct repositories and
owners. Every value has one of three verdicts:

* ``copied``: ``COPIED`` owners or more hold it, or ``SPREAD`` repositories, whoever owns them.
* ``live``: fewer hold it, and it looks like a real credential.
* Neither: fewer hold it, and it doesn't look like one.

``copied`` and ``live`` add a span over the value; the candidates themselves always stay.

Equal texts count once, for the holder of the smallest id (null ids last, then the first
owner and repository), so a document copied later changes no verdict. A text that is
nothing but its candidate is no document that was copied but the value met again: it
counts for each of its holders.

* A null text counts as empty. A null source is an owner and a repository of its own.
* Repeated rows each get a row; null and repeated ids are told apart by their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import prepare, settle, table
from tallyhouse.llm.spans import count_of, listed, matches, of_kind

# What is searched for.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"     # 20 characters and more; shorter ones hold no longer one
HEX = r"[0-9a-f]{24,}+"            # as above
KINDS = ("assign", "access", "hex")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Owners, and repositories, from which a value counts as copied; different characters of
#: a live-looking value. One owner may use a key in some repositories, so more are needed.
COPIED, SPREAD, VARIED = 3, 4, 8
#: What may stand around a candidate in a text that is nothing else.
AROUND = " \t\n\x0b\x0c\r\"';,"


def candidates(text: Column) -> Column:
    """All base spans, sorted by start and kind; ``value`` is the credential at the end of the span."""
    low = F.lower(text)
    named = low.contains(NAMES[0])
    for name in NAMES[1:]:
        named = named | low.contains(name)
    assign = F.transform(matches(text, ASSIGN, named), lambda s: s.withField("value", F.regexp_extract(s["value"], ASSIGN, 2)))
    assign = F.filter(assign, lambda s: F.length(s["value"]) >= 6)
    access = matches(text, ACCESS, text.contains("AKIA"))
    return F.array_sort(F.concat(of_kind(assign, "assign", 0), of_kind(access, "access", 1), of_kind(matches(text, HEX), "hex", 2)))


def looks_live(value: Column) -> Column:
    letters = F.array_distinct(F.split(value, ""))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(letters) >= VARIED) & ~F.lower(value).rlike("example|changeme|dummy|placeholder|xxxx")


def ownership(found: DataFrame) -> DataFrame:
    """``value``, ``repos``, ``owners`` of every candidate value. Rows are first reduced to
    distinct texts, then to distinct holders, so a value that is everywhere meets in no
    single task."""
    own = [F.when(F.col("bare"), F.col(c)).alias(f"own_{c}") for c in ("owner", "repo")]
    keyed = found.select(F.xxhash64("value").alias("hash"), "value", "h", *own, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "owner", "repo").alias("at"))
    first = keyed.groupBy("hash", "value", "h", "own_owner", "own_repo").agg(F.min("at").alias("at"))
    held = first.select("hash", "value", "at.owner", "at.repo").distinct()
    by_owner = held.groupBy("hash", "value", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("hash", "value").agg(F.sum("repos").alias("repos"), F.count("*").alias("owners"))


def secrets(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of spans) of every document."""
    prepare(docs.sparkSession)
    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("="), owner.cast("string")), F.lit("~")).alias("owner"), F.coalesce(F.concat(F.lit("="), repo.cast("string")), F.lit("~")).alias("repo"))
    held = F.length(F.btrim("text", F.lit(AROUND))).alias("held")
    base = settle(marked.select("doc_id", F.xxhash64("text").alias("h"), "owner", "repo", held, candidates(F.col("text")).alias("base")))
    found = base.filter(F.size("base") > 0).select("doc_id", "h", "owner", "repo", "held", F.explode("base").alias("s"))
    found = found.select("doc_id", "h", "owner", "repo", "s.end", "s.value", (F.col("s.end") - F.col("s.start") >= F.col("held")).alias("bare"))
    known = ownership(found)
    wide = (F.col("owners") >= COPIED) | (F.col("repos") >= SPREAD)
    verdict = F.when(wide, "copied").when(looks_live(F.col("value")), "live")
    judged = known.select("hash", F.col("value").alias("__value"), verdict.alias("verdict")).filter(F.col("verdict").isNotNull())
    places = found.select("doc_id", "h", "end", "value").distinct()
    met = places.join(judged, (F.xxhash64("value") == F.col("hash")) & (F.col("value") == F.col("__value")))
    start = (F.col("end") - F.length("value")).alias("start")
    more = met.groupBy("doc_id", "h").agg(F.collect_set(F.struct(start, F.lit(9).alias("order"), "end", F.col("verdict").alias("kind"), "value")).alias("more"))
    more = more.withColumnsRenamed({"doc_id": "__id", "h": "__h"})
    out = base.select("doc_id", "h", "base").join(more, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left")
    return out.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", F.filter("base", lambda s: F.lit(False))))).alias("spans"))


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = secrets(docs, owner=F.col("source"), repo=F.concat_ws("/", "source", "lang"))
    counts = [count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS]
    return out.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
