"""Personal data: patterns first, then bootstrapped contextual extraction; DataFrame operations only.

Base spans (email, ip, card, phone) are the *seed entities*: each is one instance, its
whole value, with or without blanks and digits. Tokens with a digit outside of base spans
are the unseen instances. The (up to two) words before an instance in the text are a
lexical pattern. Patterns and instances form a bipartite graph that is scored in rounds: a
pattern is as trustworthy as its distinct instances, an instance that is no seed as its
best pattern. Instances of patterns above ``SURE`` become spans of kind ``ctx``; base
spans always stay. Of base spans within each other only the outermost is an instance.

* A null text counts as empty.
* Repeated rows each get a row; null and repeated ids are told apart by their texts.
* A graph without seeds has no trusted pattern and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import prepare, settle, table, texts
from tallyhouse.llm.spans import count_of, listed, matches, of_kind, running

# What is searched for. Possessive runs and the tests before them only keep
# long runs from being tried from each of their places; they match the same text.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

#: A token with a digit; code points a pattern is taken from; its blanks; code points of a piece of text.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
CONTEXT, BLANK, PIECE = 80, r"[\x20\x09-\x0D]+", 512

#: Rounds of scoring; trust from which a pattern extracts; distinct seeds it needs; least length of a find.
ROUNDS, SURE, SEEDS, LEAST = 3, 0.8, 3, 5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right counts twice, its digits added."""
    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _part_ok(part: Column) -> Column:
    short = F.ltrim(part, F.lit("0"))
    return F.when(F.length(short) > 3, False).otherwise(F.coalesce(F.try_to_number(F.lpad(short, 3, "0"), F.lit("000")), F.lit(0)) <= 255)


def entities(text: Column) -> Column:
    """All base spans, sorted by start and kind."""
    digit = text.rlike("[0-9]")
    email = matches(text, EMAIL, text.contains("@"))
    ip = F.filter(matches(text, IP, digit), lambda s: F.forall(F.split(s["value"], r"\."), _part_ok))
    card = F.filter(matches(text, CARD, digit), lambda s: F.length(s["value"]) >= 14)
    card = F.filter(card, lambda s: F.when(F.length(_digits(s["value"])).between(14, 19), _luhn(_digits(s["value"]))).otherwise(False))
    phone = F.filter(matches(text, PHONE, text.contains("+")), lambda s: F.length(_digits(s["value"])).between(10, 15))
    return F.array_sort(F.concat(of_kind(email, "email", 0), of_kind(ip, "ip", 1), of_kind(card, "card", 2), of_kind(phone, "phone", 3)))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once: as the element of a one-element array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _farthest(values: Column) -> Column:
    """The largest of all values before each one."""
    return running(values, -1, lambda acc, x: F.greatest(acc, x))


def outermost(base: Column) -> Column:
    """Spans that lie within no other. In order of their starts, longer ones first, a span
    lies in another if one before it ends no earlier."""
    order = F.array_sort(F.transform(base, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["order"].alias("order"), s.alias("span"))))

    def kept(spans: Column) -> Column:
        ends = _farthest(F.transform(spans, lambda s: -s["back"]))
        met = F.zip_with(spans, ends, lambda s, far: F.struct(s["span"].alias("span"), (far < -s["back"]).alias("out")))
        return F.transform(F.filter(met, lambda x: x["out"]), lambda x: x["span"])

    return F.when(F.size(base) == 0, base).otherwise(_once(order, kept))


def outside(tokens: Column, base: Column) -> Column:
    """Tokens (``start``, ``end`` and more) that meet no span of ``base``: of the spans that
    start before a token ends, none ends behind its start. One sweep over both, sorted."""
    none = F.lit(None).cast("struct<start:bigint,end:bigint,value:string,from:bigint>")
    events = F.array_sort(F.concat(
        F.transform(tokens, lambda t: F.struct(t["end"].alias("at"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("far"), t.alias("token"))),
        F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("kind"), b["end"].alias("far"), none.alias("token")))))

    def kept(events: Column) -> Column:
        met = F.zip_with(events, _farthest(F.transform(events, lambda e: e["far"])), lambda e, far: F.struct(
            e["token"].alias("token"), (e["kind"] == 0).alias("is_token"), far.alias("far")))
        free = F.filter(met, lambda x: F.when(x["is_token"], x["far"] <= x["token"]["start"]).otherwise(False))
        return F.transform(free, lambda x: x["token"])

    return F.when(F.size(tokens) == 0, tokens).otherwise(_once(events, kept))


def marked(text: Column) -> Column:
    """``base`` (all base spans), and ``seeds`` and ``tokens``: ``start``, ``end``, ``value``
    and ``before`` (the last ``CONTEXT`` code points before it) of the outermost base spans
    and of all tokens with a digit outside of base spans, without marks at their ends. A text
    is cut into pieces once, so that what stands before a place is found without walking
    over the whole text."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def placed(pieces: Column, s: Column, start: Column) -> Column:
        at = F.floor(start / PIECE).cast("int")
        last = F.left(F.coalesce(F.get(pieces, at), F.lit("")), (start % PIECE).cast("int"))
        before = F.right(F.concat(F.coalesce(F.get(pieces, at - 1), F.lit("")), last), F.lit(CONTEXT))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), before.alias("before"))

    def trimmed(s: Column) -> Column:
        head, tail = (F.length(F.regexp_extract(s["value"], p, 0)) for p in ("^[^A-Za-z0-9]+", "[^A-Za-z0-9]++$"))
        return F.struct((s["start"] + head).alias("start"), (s["end"] - tail).alias("end"),
                        F.substring(s["value"], F.lit(1) + head, F.length(s["value"]) - head - tail).alias("value"), s["start"].alias("from"))

    tokens = F.transform(matches(text, TOKEN, text.rlike("[0-9]")), trimmed)
    parts = F.struct(entities(text).alias("base"), tokens.alias("tokens"), pieces.alias("pieces"))
    return _once(parts, lambda x: F.struct(
        x["base"].alias("base"), F.transform(outermost(x["base"]), lambda s: placed(x["pieces"], s, s["start"])).alias("seeds"),
        F.transform(outside(x["tokens"], x["base"]), lambda s: placed(x["pieces"], s, s["from"])).alias("tokens")))


def _pattern(before: Column) -> Column:
    """The last two words; marks that touch the instance belong to neither."""
    words = F.filter(F.split(F.lower(F.regexp_replace(before, r"[^A-Za-z0-9\x20\x09-\x0D]++$", "")), BLANK), lambda w: w != "")
    return F.array_join(F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2)), " ")


def instances(found: DataFrame) -> DataFrame:
    """``doc_id``, ``h``, ``start``, ``end``, ``token``, ``pattern``, ``seed``: the outermost
    base spans as seeds, and every token with a digit outside of base spans."""
    pattern = _pattern(F.col("before")).alias("pattern")
    def each(column: str, seed: bool) -> DataFrame:
        rows = found.filter(F.size(column) > 0).select("doc_id", "h", F.explode(column).alias("t")).select("doc_id", "h", "t.*")
        return rows.select("doc_id", "h", "start", "end", F.col("value").alias("token"), pattern, F.lit(seed).alias("seed"))

    return each("seeds", True).unionByName(each("tokens", False))


def trusted(rows: DataFrame, rounds: int = ROUNDS, sure: float = SURE, seeds: int = SEEDS) -> DataFrame:
    """``pattern`` of every pattern that is trusted after ``rounds`` rounds over the graph."""
    edges = rows.filter(F.col("pattern") != "").groupBy("pattern", "token").agg(F.max("seed").alias("seed"))
    # A pattern of fewer instances than the seeds it needs can never be trusted.
    enough = edges.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= seeds).select("pattern")
    edges = settle(edges.join(enough, "pattern"))
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    for turn in range(rounds):
        trust = scored.groupBy("pattern").agg(
            (F.sum("score") / (F.count("*") + 1)).alias("trust"), F.sum((F.col("score") >= sure).cast("long")).alias("held")).filter(F.col("held") >= seeds)
        trust = settle(trust.select("pattern", "trust"))
        if turn + 1 < rounds:
            best = edges.join(trust, "pattern").groupBy("token").agg(F.max("trust").alias("best"))
            score = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
            scored = settle(edges.join(best, "token", "left").select("pattern", "token", "seed", score.alias("score")))
    return trust.filter(F.col("trust") >= sure).select("pattern")


def personal(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of spans) of every document."""
    prepare(docs.sparkSession)
    base = settle(texts(docs).select("doc_id", "h", marked(F.col("text")).alias("m"))).select("doc_id", "h", "m.*")
    rows = settle(instances(base).dropDuplicates(["doc_id", "h", "start"]))
    new = rows.filter(~F.col("seed") & (F.length("token") >= LEAST)).join(trusted(rows), "pattern")
    more = new.groupBy("doc_id", "h").agg(F.collect_set(F.struct(
        "start", F.lit(9).alias("order"), "end", F.lit("ctx").alias("kind"), F.col("token").alias("value"))).alias("more"))
    more = more.withColumnsRenamed({"doc_id": "__id", "h": "__h"})
    out = base.drop("seeds", "tokens").join(more, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left")
    return out.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", F.filter("base", lambda s: F.lit(False))))).alias("spans"))


def op6_pii(spark, sf_dir: str) -> DataFrame:
    out = personal(table(spark, sf_dir, "documents"))
    counts = [count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS]
    return out.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
