"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

An item is cut into windows of 13 words (a shorter item is one window). A window is the
set of its five-word shingles (a shorter window is one shingle). To contain a window a
text must hold *all* its shingles, so one necessary shingle per window, the rarest in
the corpus, is joined (prefix length one). Its place in the text and in the window give
the only start a window can have; starts before the text or ends beyond it are discarded
(position and length bound), the rest is compared word by word.

Benchmark shingles are counted over the whole corpus in the pass that finds them, which
also keeps one row per text with its number of words; texts are read once more for those
that hold a prefix shingle. The benchmark's side of the joins is left to Spark's size
statistics, as it may have any size.

* A null or empty text has no words, no hits and is not contaminated.
* A null or empty item has no window. Equal items are both reported, under their ids;
  a null ``item_id`` takes part in hits but is not listed.
* Repeated rows each get a row; null and repeated ids are told apart by their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyhouse.llm.common import free, prepare, same_key, settle, table, texts, with_findings, words_of

WINDOW, SHINGLE = 13, 5
#: The rows that keep the number of words of a text are dealt over so many keys of the join.
MARKS = 1000
#: A text is contaminated if this many times its hit words are at least all its words.
PART = 20


def shingle_rows(df: DataFrame, words: str, size: int, *keep: str) -> DataFrame:
    """One row per run of ``size`` words: ``keep``, ``pos`` and ``sh``, the run as text."""
    run = [F.slice(words, i + 1, F.greatest(F.size(words) - (size - 1), F.lit(0))).alias(f"w{i}") for i in range(size)]
    rows = df.select(*keep, F.posexplode(F.arrays_zip(*run)).alias("pos", "z"))
    return rows.select(*keep, "pos", F.concat_ws(" ", *[F.col("z").getField(f"w{i}") for i in range(size)]).alias("sh"))


def marked_rows(docs: DataFrame, size: int) -> DataFrame:
    """``shingle_rows`` of ``docs`` (``doc_id``, ``h``, ``w``, ``n_words``) and one more row per
    text, also per text of no words, in which ``sh`` is a mark: a blank and a number."""
    runs = F.greatest(F.col("n_words").cast("int") - (size - 2), F.lit(1))
    cut = [F.slice("w", i + 1, runs).alias(f"w{i}") for i in range(size)]
    rows = docs.select("doc_id", "h", "n_words", F.posexplode_outer(F.arrays_zip(*cut)).alias("pos", "z"))
    # The run beyond the last one lacks its last word.
    words = [F.col("z").getField(f"w{i}") for i in range(size)]
    mark = F.concat(F.lit(" "), F.pmod("h", F.lit(MARKS)).cast("string"))
    return rows.select("doc_id", "h", "n_words", "pos", F.when(words[-1].isNull(), mark).otherwise(F.concat_ws(" ", *words)).alias("sh"))


def marks(spark) -> DataFrame:
    return spark.range(MARKS).select(F.concat(F.lit(" "), F.col("id").cast("string")).alias("sh"))


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """``win`` (its words as text), ``len``, ``words`` of every distinct window, and the ids
    of the items that hold it, one row each."""
    cut = items.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("w"))
    cut = cut.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    cut = cut.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, width))).alias("words"))
    return cut.select("item_id", F.array_join("words", " ").alias("win"), F.size("words").alias("len"), "words").distinct()


def prefixes(wins: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """The rarest shingle of each window: ``win``, ``len``, ``sh``, ``off`` (its first place).

    ``counts``: how often each benchmark shingle occurs in the corpus."""
    long = shingle_rows(wins.filter(F.col("len") >= size), "words", size, "win", "len")
    ranked = long.join(counts, "sh", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = ranked.groupBy("win", "len").agg(F.min(F.struct("n", "sh", "pos")).alias("b"))
    return best.filter(F.col("b.n") > 0).select("win", "len", F.col("b.sh").alias("sh"), F.col("b.pos").alias("off"))


def occurrences(plain: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``h``, ``win``, ``start``, ``len`` of every window found in ``plain`` (from
    ``texts``); and ``doc_id``, ``h``, ``n_words`` of every row of ``plain``."""
    docs = plain.select("doc_id", "h", words_of(F.col("text")).alias("w")).withColumn("n_words", F.size("w").cast("long"))
    wins = settle(windows(items).select("win", "len", "words").distinct())
    out = counted = None
    # Windows of fewer words than a shingle are their own shingle: one pass for each such
    # length there is, at most five in all. The first counts the words.
    sizes = sorted({min(SHINGLE, r["len"]) for r in wins.select(F.least("len", F.lit(SHINGLE)).alias("len")).distinct().collect()})
    for size in sizes:
        mine = wins.filter(F.least("len", F.lit(SHINGLE)) == size)
        wanted = shingle_rows(mine, "words", size, "win").select("sh").distinct()
        if counted is None:
            rows = settle(marked_rows(docs, size).join(wanted.unionByName(marks(plain.sparkSession)), "sh"))
            counted = rows.filter(F.col("sh").startswith(" ")).select("doc_id", "h", "n_words")
            seen = rows.filter(~F.col("sh").startswith(" "))
        else:
            seen = settle(shingle_rows(docs, "w", size, "doc_id", "h", "n_words").join(wanted, "sh"))
        counts = seen.groupBy("sh").agg(F.count("*").alias("n"))
        starts = seen.join(prefixes(mine, counts, size), "sh").withColumn("start", F.col("pos") - F.col("off"))
        starts = starts.filter((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
        starts = starts.select("doc_id", "h", "win", "start", "len")
        out = starts if out is None else out.unionByName(starts)
    if out is None:
        none = docs.select("doc_id", "h", F.lit("").alias("win"), F.lit(0).alias("start"), F.lit(0).alias("len")).filter("false")
        return none, docs.select("doc_id", "h", "n_words")
    found = settle(out.distinct())
    # Verify: cut the candidate places out of the texts and compare them with the windows.
    places = found.groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "len")).alias("places"))
    held = with_findings(plain, places).filter(F.col("places").isNotNull()).withColumn("w", words_of(F.col("text")))
    cut = held.select("doc_id", "h", F.explode(F.transform("places", lambda p: F.struct(
        p["start"].alias("start"), p["len"].alias("len"), F.array_join(F.slice("w", p["start"] + 1, p["len"]), " ").alias("is")))).alias("p"))
    cut = cut.select("doc_id", "h", "p.start", "p.len", "p.is").distinct().withColumnsRenamed({"doc_id": "__id", "h": "__h", "start": "__s", "len": "__l"})
    same = (F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")) & (F.col("start") == F.col("__s"))
            & (F.col("len") == F.col("__l")) & (F.col("win") == F.col("is")))
    return found.join(cut, same, "left_semi"), counted


def covered(hits: DataFrame) -> DataFrame:
    """``n_hit``: words inside any occurrence, per row."""
    spans = hits.select("doc_id", "h", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    before = F.max("end").over(W.partitionBy("doc_id", "h").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    fresh = F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0)))
    return spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy("doc_id", "h").agg(F.sum("fresh").cast("long").alias("n_hit"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id``, ``h``, ``n_words``, ``n_hit``, ``item_ids`` (sorted as strings), ``contaminated``."""
    prepare(docs.sparkSession)
    plain = texts(docs)
    hits, counted = occurrences(plain, items)
    hits = settle(hits)
    listed = hits.select("doc_id", "h", "win").distinct().join(windows(items).select("win", "item_id"), "win")
    listed = listed.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    found = covered(hits).join(listed.withColumnsRenamed({"doc_id": "__i", "h": "__k"}),
                               F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("h") == F.col("__k")), "left").drop("__i", "__k")
    out = with_findings(counted, found)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids: Column = F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select("doc_id", "h", "n_words", n_hit.alias("n_hit"), ids.alias("item_ids"), ((n_hit > 0) & (n_hit * PART >= F.col("n_words"))).alias("contaminated"))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    id_, h = free(docs, "__id", "__h")
    bad = contamination(docs, items).filter("contaminated").select(F.col("doc_id").alias(id_), F.col("h").alias(h)).distinct()
    return docs.join(bad.hint("shuffle_hash"), same_key(docs, id_, h), "left_anti")


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = "[x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> '']"

OP1_SQL = f"""
with d as materialized (
  select doc_id, row_number() over () as r, {_WORDS} as w from documents
), i as (
  select item_id, {_WORDS} as w from benchmark
), win as (
  select distinct item_id, len(x) as n, array_to_string(x, ' ') as win
  from (select item_id, unnest([w[s:s + 12] for s in range(1, greatest(len(w) - 12, 1) + 1)]) as x from i where len(w) > 0)
), sizes as (
  select distinct n from win
), grams as (
  select r, n, s, array_to_string(w[s:s + n - 1], ' ') as win
  from (select r, n, w, unnest(range(1, len(w) - n + 2)) as s from d, sizes where len(w) >= n)
), hits as materialized (
  select g.r, g.s, g.n, win.item_id from grams g join win on g.win = win.win and g.n = win.n
), hit_words as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from (select distinct r, s, n from hits)) group by 1
), listed as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct r, cast(item_id as varchar) as item_id from hits) group by 1
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit_words using (r) left join listed using (r)
"""
