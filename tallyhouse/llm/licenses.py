"""License scans by diagonal voting, in DataFrame operations only.

Every rolling word k-gram of every text (k = 3; 2 for phrases of two words and notices of
less than six, where one changed word can leave no three in a row) is hashed and joined to
its places in the templates; the words are compared, so a vote is never a hash collision.
Votes are summed by *diagonal*, the text position minus the template position. A diagonal
with all its votes is an exact occurrence. Neighbouring diagonals (words inserted or left
out) are merged, and the words of a merged span are aligned with those of the template. It
counts if its votes cover enough different places of the template, or if few enough words
of the template are inserted, dropped or replaced. For the latter the words that name the
licence (those of the label: ``mit``, ``nc``, a version) must all stand there: another name
is another licence. Of notices that begin at the same word, those with the least changes
count; ties all count.

The templates are a fixed list, which bounds what is broadcast.

* A null or empty text has no words, no places and no labels.
* Repeated rows each get a row; null and repeated ids are told apart by their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyhouse.llm.common import prepare, settle, table, texts, with_findings, words_of

# Phrases and labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Well-known notices, as words.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "is licensed under the gnu general public license version 3": "gpl-3",
    "is licensed under the gnu general public license version 2": "gpl-2",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
}

#: Neighbouring diagonals are at most this far apart; part of a notice's places that must
#: vote, or of its words that must stay unchanged.
NEAR, PART = 3, 0.7
#: Notices of fewer words are found by pairs; what a lost word of the licence's name costs.
SHORT, NAME = 6, 1000


def templates(spark) -> DataFrame:
    """``tid``, ``label``, ``base``, ``k``, ``places`` (k-grams in all), ``off``, ``gram``; a few hundred rows."""
    rows = []
    for tid, (text, label) in enumerate([*BASE.items(), *NOTICES.items()]):
        words = text.split()
        k = min(3, len(words)) if tid < len(BASE) or len(words) >= SHORT else 2
        rows += [(tid, label, tid < len(BASE), k, len(words) - k + 1, i, " ".join(words[i:i + k])) for i in range(len(words) - k + 1)]
    return spark.createDataFrame(rows, "tid int, label string, base boolean, k int, places int, off int, gram string")


def votes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``h``, ``pos`` and a template's columns for every k-gram found in it; and
    ``doc_id``, ``h``, ``n_words`` of every row of ``docs``. Both come from one pass: the row
    of a text's last word, which begins no pair, tells how many words there are."""
    known = templates(docs.sparkSession)
    split = docs.select("doc_id", "h", words_of(F.col("text")).alias("w"))
    grams = split.select("doc_id", "h", F.posexplode_outer(F.arrays_zip(
        F.col("w").alias("a"), F.slice("w", F.lit(2), F.greatest(F.size("w"), F.lit(1))).alias("b"),
        F.slice("w", F.lit(3), F.greatest(F.size("w"), F.lit(1))).alias("c"))).alias("pos", "z")).select("doc_id", "h", "pos", "z.a", "z.b", "z.c")
    by_hash = known.groupBy("k", F.xxhash64("gram").alias("hash")).agg(F.collect_list(F.struct("gram", "tid", "label", "base", "k", "places", "off")).alias("at"))
    for k, cols in ((2, ["a", "b"]), (3, ["a", "b", "c"])):
        mine = F.broadcast(by_hash.filter(F.col("k") == k).select(F.col("hash").alias(f"hash{k}"), F.col("at").alias(f"at{k}")))
        grams = grams.withColumn(f"gram{k}", F.concat_ws(" ", *cols))
        grams = grams.join(mine, F.xxhash64(f"gram{k}") == F.col(f"hash{k}"), "left")
    grams = grams.withColumn("last", F.col("b").isNull())
    grams = settle(grams.filter(F.col("at2").isNotNull() | F.col("at3").isNotNull() | F.col("last")).select("doc_id", "h", "pos", "last", "gram2", "gram3", "at2", "at3"))
    counted = grams.filter("last").select("doc_id", "h", (F.coalesce("pos", F.lit(-1)) + 1).cast("long").alias("n_words"))
    none = F.filter(F.coalesce("at2", "at3"), lambda x: F.lit(False))
    found = grams.select("doc_id", "h", "pos", "gram2", "gram3", F.explode(F.concat(F.coalesce("at2", none), F.coalesce("at3", none))).alias("t"))
    same = F.col("t.gram") == F.when(F.col("t.k") == 2, F.col("gram2")).otherwise(F.col("gram3"))
    return found.filter(same).select("doc_id", "h", "pos", "t.tid", "t.label", "t.base", "t.k", "t.places", "t.off"), counted


def edits(words: Column, template: Column) -> Column:
    """Least number of words inserted, dropped or replaced that turn ``template`` (an array of
    ``word`` and ``cost``, what losing it costs) into some run of ``words``."""
    def step(acc: Column, x: Column) -> Column:
        def cell(row: Column, t: Column, j: Column) -> Column:
            old, left = acc["row"], F.element_at(row, -1)
            same = F.get(old, j) + F.when(t["word"] == x, 0).otherwise(t["cost"])
            return F.concat(row, F.array(F.least(same, F.get(old, j + 1) + 1, left + t["cost"])))

        placed = F.transform(template, lambda t, j: F.struct(t["word"].alias("word"), t["cost"].alias("cost"), j.alias("j")))
        row = F.aggregate(placed, F.array(F.lit(0)), lambda row, t: cell(row, t, t["j"]))
        return F.transform(F.array(row), lambda r: F.struct(r.alias("row"), F.least(acc["best"], F.element_at(r, -1)).alias("best")))[0]

    # Before any word of the text, all words of the template so far are lost.
    lost = F.aggregate(template, F.array(F.lit(0)), lambda row, t: F.concat(row, F.array(F.element_at(row, -1) + t["cost"])))
    return F.aggregate(words, F.struct(lost.alias("row"), F.element_at(lost, -1).alias("best")), step, lambda acc: acc["best"])


def aligned(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``runs`` (``lo`` and ``hi``: first and last diagonal) with ``m``, the words of the
    template, and ``edits``. Only documents that have runs are cut into words again."""
    notices = F.array(*[F.array(*[F.struct(F.lit(w).alias("word"), F.lit(NAME if w in label.replace(".", "-").split("-") else 1).alias("cost")) for w in text.split()])
                        for text, label in NOTICES.items()])
    each = runs.groupBy("doc_id", "h").agg(F.collect_list(F.struct(*[c for c in runs.columns if c not in ("doc_id", "h")])).alias("runs"))
    each = each.withColumnsRenamed({"doc_id": "__id", "h": "__h"})
    held = docs.join(each.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(each["__id"]) & (docs["h"] == each["__h"]))
    template = F.get(notices, F.col("r.tid") - len(BASE))

    def near(words: Column, r: Column) -> Column:
        first = F.greatest(r["lo"] - NEAR, F.lit(0))
        size = F.size(F.get(notices, r["tid"] - len(BASE)))
        return F.struct(r.alias("r"), F.slice(words, first + 1, F.greatest(r["hi"] + size + NEAR - first, F.lit(0))).alias("near"))

    cut = F.flatten(F.transform(F.array(words_of(F.col("text"))), lambda words: F.transform("runs", lambda r: near(words, r))))
    # Rows repeated in full have the same runs.
    rows = held.select("doc_id", "h", F.explode(cut).alias("x")).select("doc_id", "h", "x.r", "x.near").dropDuplicates(["doc_id", "h", "r"])
    return rows.select("doc_id", "h", "r.*", F.size(template).alias("m"), edits(F.col("near"), template).alias("edits"))


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``h``, ``label``, ``base``, ``start``, ``end`` (in words) and ``score`` of
    every verified span; and ``doc_id``, ``h``, ``n_words`` of every row. ``docs`` comes from
    ``texts``."""
    cast, counted = votes(docs)
    cast = cast.dropDuplicates(["doc_id", "h", "tid", "pos", "off"]).withColumn("diag", F.col("pos") - F.col("off"))
    by_diag = settle(cast.groupBy("doc_id", "h", "tid", "label", "base", "k", "places", "diag").agg(
        F.count("*").alias("n"), F.min("pos").alias("start"), F.max(F.col("pos") + F.col("k")).alias("end"), F.collect_set("off").alias("offs")))
    exact = by_diag.filter(F.col("base") & (F.col("n") == F.col("places"))).select("doc_id", "h", "label", "base", "start", "end", F.lit(1.0).alias("score"))
    # A run of diagonals, each near the one before it, is one span.
    order = W.partitionBy("doc_id", "h", "tid").orderBy("diag")
    first = F.coalesce(F.col("diag") - F.lag("diag").over(order) > NEAR, F.lit(True))
    runs = by_diag.filter(~F.col("base")).withColumn("first", first.cast("int")).withColumn("run", F.sum("first").over(order))
    merged = runs.groupBy("doc_id", "h", "tid", "label", "base", "places", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("diag").alias("lo"), F.max("diag").alias("hi"),
        F.size(F.array_distinct(F.flatten(F.collect_list("offs")))).alias("held"))
    merged = aligned(docs, settle(merged))
    kept = F.greatest(F.lit(0.0), 1 - F.col("edits") / F.col("m"))
    merged = merged.withColumn("score", F.greatest(F.col("held") / F.col("places"), kept)).filter(F.col("score") >= PART)
    # Of notices that begin at the same word (versions of one licence) those changed least count.
    best = F.min("edits").over(W.partitionBy("doc_id", "h", "start"))
    merged = merged.withColumn("best", best).filter(F.col("edits") == F.col("best"))
    return exact.unionByName(merged.select("doc_id", "h", "label", "base", "start", "end", "score")), counted


def licensed(docs: DataFrame) -> DataFrame:
    """One row per document with its places, labels and score."""
    prepare(docs.sparkSession)
    plain = texts(docs)
    base = F.col("base")
    found, counted = spans(plain)
    found = found.groupBy("doc_id", "h").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"), F.collect_set(F.when(base, F.col("label"))).alias("base_set"),
        F.collect_set("label").alias("label_set"), F.max("score").alias("score"))
    out = with_findings(counted, found)
    joined = [F.coalesce(F.array_join(F.array_sort(c), ","), F.lit("")).alias(n) for c, n in (("base_set", "base_labels"), ("label_set", "labels"))]
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"), *joined, F.coalesce("score", F.lit(0.0)).alias("score"))


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    return licensed(table(spark, sf_dir, "documents"))
