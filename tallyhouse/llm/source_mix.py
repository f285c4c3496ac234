"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents are summed by their *membership pattern* (the sorted set of sources they
belong to). Each pattern supplies its tokens in layers: the first use of a token is
free, every further use costs more than the one before (convex), up to ``uses``. The
flow routes that capacity to the quotas of the sources at the least cost.

A source none of whose documents belongs to another as well leaves nothing to route: it
gives its quota, or all its uses. Such sources stay in Spark, any number of them, and so do
the targets: a level is found by sums, a few numbers a round. Only the patterns of
overlapping sources, and of the sources they touch, reach the driver and its flow: at most
``max_patterns``, beyond which the job stops with an error instead of cutting anything.

Each pattern's share is then taken from its documents in a seeded order. The order is
cut into ``BUCKETS`` hash ranges; only the one range a cut falls into is ordered row by
row, so no source, however large, is sorted in one task. The document at the cut gives
only its first words that are still wanted, so a pattern's words match its flow exactly.

* A null text has size 0; a null source is a source of its own, last in order.
* Rows repeated in full are told apart by nothing: which of them is cut is immaterial.
* An empty table has no targets and gives no rows.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyhouse.llm.common import prepare, settle, table
from tallyhouse.plans.distinct import number_keys

BUCKETS = 4096
SEED = 20240607
#: Weights of the sources in their order, repeated as needed.
WEIGHTS = (5, 2, 1)
#: What the sources share together, as a multiple of all sizes; what one may get, of its own.
SHARE, MOST = Fraction(3, 2), 2


def targets(sizes: dict, weights=WEIGHTS, share=SHARE, most=MOST) -> dict:
    """Share ``share`` times all sizes by weight; none gets over ``most`` times its size,
    and what it leaves is shared among the others until nobody is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
            open_.remove(s)
    return out


def route(patterns: dict[tuple, int], quotas: dict, uses: int = 2) -> dict[tuple, int]:
    """Min-cost flow: tokens each pattern gives, repeated uses counted.

    Successive cheapest augmenting paths (label correcting over the residual graph). An
    edge of a pattern's second layer costs 1, of the third 3, and so on (convex)."""
    start, end, arcs, out = "start", "end", [], {}

    def arc(a, b, room, cost):
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            out.setdefault(x, []).append(len(arcs))
            arcs.append([y, r, c])

    for p, size in patterns.items():
        for layer in range(uses):
            arc(start, ("p", p), size, layer * layer)
        for s in p:
            arc(("p", p), ("s", s), uses * size, 0)
    for s, quota in quotas.items():
        arc(("s", s), end, quota, 0)
    potential: dict = {}
    while True:
        cost, came, heap, tie = {start: 0}, {}, [(0, 0, start)], 0
        done = set()
        while heap:
            d, _, x = heapq.heappop(heap)
            if x in done:
                continue
            done.add(x)
            for i in out.get(x, ()):
                y, room, c = arcs[i]
                new = d + c + potential.get(x, 0) - potential.get(y, 0)
                if room > 0 and y not in done and new < cost.get(y, 1 << 62):
                    cost[y], came[y] = new, i
                    tie += 1
                    heapq.heappush(heap, (new, tie, y))
        if end not in came:
            break
        for x in set(potential) | set(cost):
            potential[x] = potential.get(x, 0) + min(cost.get(x, cost[end]), cost[end])
        path, x = [], end
        while x != start:
            path.append(came[x])
            x = arcs[came[x] ^ 1][0]
        push = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= push
            arcs[i ^ 1][1] += push
    given = dict.fromkeys(patterns, 0)
    for i in range(0, len(arcs), 2):
        if arcs[i ^ 1][0] == start:
            given[arcs[i][0][1]] += arcs[i ^ 1][1]
    return given


def quotas(sums: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """``source``, ``n`` (its size), ``target`` and ``quota`` (rounded) of every source.

    The same as ``targets``: a source gets ``weight * level``, or ``most * n`` where that is
    less. The level rises until what the sources get is what they share; each round takes
    two sums over the sources."""
    place = (F.col("number") - 1) % len(weights)
    rows = sums.join(number_keys(sums, "source"), "source")
    rows = settle(rows.select("source", F.col("n").cast("long").alias("n"), F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).alias("weight")))

    def full(level: Fraction):
        """``most * n < level * weight``, in whole numbers."""
        out = F.lit(False)
        for w in sorted(set(weights)):
            out = out | ((F.col("weight") == w) & (F.col("n") < math.ceil(level * w / most)))
        return out

    total, weight = rows.agg(F.sum("n"), F.sum("weight")).first()
    if not weight:
        return rows.select("source", "n", F.lit(0.0).alias("target"), F.lit(0).cast("long").alias("quota"))
    level = share * int(total) / int(weight)
    while True:
        held, open_ = rows.agg(F.sum(F.when(full(level), F.col("n"))), F.sum(F.when(~full(level), F.col("weight")))).first()
        if not open_:
            break
        new = (share * int(total) - most * int(held or 0)) / int(open_)
        if new == level:
            break
        level = new
    by_weight = [(w, float(level * w), round(level * w)) for w in sorted(set(weights))]
    target, quota = (F.coalesce(*[F.when(F.col("weight") == row[0], F.lit(row[i])) for row in by_weight]) for i in (1, 2))
    own = F.col("n") * most
    return rows.select("source", "n", F.when(full(level), own.cast("double")).otherwise(target).alias("target"),
                       F.when(full(level), own).otherwise(quota.cast("long")).alias("quota"))


def shares(sums: DataFrame, goal: DataFrame, uses: int, max_patterns: int) -> DataFrame:
    """``__p``, ``__full`` (whole uses of its documents) and ``__rest`` (words of one more) of
    every pattern, from the words of each (``__p``, ``n``) and the quotas."""
    spark = sums.sparkSession
    tangled = settle(sums.filter(F.size("__p") > 1).select(F.explode("__p").alias("source")).distinct())
    met = F.size("__p") == 1
    single = sums.filter(met).withColumn("source", F.element_at("__p", 1))
    alone = single.join(tangled, "source", "left_anti").join(goal.select("source", "quota"), "source")
    given = F.least("quota", F.col("n") * uses)
    used = F.when(F.col("n") > 0, F.col("n"))
    plan = alone.select("__p", F.coalesce(F.floor(given / used), F.lit(0)).cast("long").alias("__full"), F.coalesce(given % used, F.lit(0)).cast("long").alias("__rest"))
    routed = sums.filter(~met).unionByName(single.join(tangled, "source", "left_semi").drop("source")).limit(max_patterns + 1).collect()
    if len(routed) > max_patterns:
        raise ValueError(f"over {max_patterns} membership patterns of overlapping sources; merge sources or raise max_patterns")
    if not routed:
        return settle(plan)
    patterns = {tuple(r["__p"]): int(r["n"] or 0) for r in routed}
    wanted = goal.join(tangled, "source", "left_semi").select("source", "quota").collect()      # sources of those patterns
    flow = route(patterns, {r["source"]: r["quota"] for r in wanted}, uses)
    rows = [(list(p), flow[p] // n if n else 0, flow[p] % n if n else 0) for p, n in patterns.items()]
    return settle(plan.unionByName(spark.createDataFrame(rows, "__p array<string>, __full long, __rest long")))


def mix(docs: DataFrame, members: str = "members", size: str = "size", weights=WEIGHTS, seed: int = SEED, uses: int = 2,
        max_patterns: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``taken``: the words of each row the mix takes; and ``quotas``.

    ``docs`` has ``doc_id``, ``h``, an array column of the sources each row belongs to
    and a size. Quotas are computed over what each source holds."""
    pattern = F.array_sort(F.array_distinct(members)).alias("__p")
    marked = docs.select("*", pattern)
    sums = settle(marked.groupBy("__p").agg(F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("n")))
    held = sums.select(F.explode("__p").alias("source"), "n").groupBy("source").agg(F.sum("n").alias("n"))
    goal = settle(quotas(settle(held), weights, most=uses))
    plan = shares(sums, goal, uses, max_patterns)

    draw = F.xxhash64(F.lit(seed), "doc_id", "h")
    drawn = marked.withColumns({"__draw": draw, "__b": F.shiftrightunsigned(draw, 52)}).join(plan, "__p")
    buckets = drawn.groupBy("__p", "__b").agg(F.sum(size).alias("__n"))
    before = F.sum("__n").over(W.partitionBy("__p").orderBy("__b").rowsBetween(W.unboundedPreceding, -1))
    buckets = buckets.select("__p", "__b", "__n", F.coalesce(before, F.lit(0)).alias("__before"))
    cut = drawn.join(buckets, ["__p", "__b"])
    whole = F.col("__before") + F.col("__n") <= F.col("__rest")
    none = F.col("__before") >= F.col("__rest")
    easy = cut.filter(whole | none).withColumn("taken", F.col(size) * (F.col("__full") + F.when(whole, 1).otherwise(0)))
    inside = W.partitionBy("__p", "__b").orderBy("__draw", "doc_id", "h").rowsBetween(W.unboundedPreceding, -1)
    room = F.col("__rest") - F.col("__before") - F.coalesce(F.sum(size).over(inside), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col(size), room))
    hard = cut.filter(~(whole | none)).withColumn("taken", F.col(size) * F.col("__full") + part)
    out = easy.unionByName(hard).drop("__p", "__full", "__rest", "__draw", "__b", "__n", "__before")
    return out, goal


def mixed_documents(docs: DataFrame, keep_key: bool = False) -> DataFrame:
    """One row per document: ``size``, ``source_size``, ``target``, ``taken``; with
    ``keep_key`` also ``h`` and ``source``."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = settle(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size")))
    # A null source travels as a one-element set under a name no source can have.
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit("~"))
    out, goal = mix(sized.withColumn("members", F.array(name)), weights=WEIGHTS)
    info = goal.select(F.col("source").alias("__s"), F.col("n").alias("source_size"), "target")
    out = out.join(info, F.element_at("members", 1) == F.col("__s"))
    return out.select("doc_id", *["h", "source"][:2 * keep_key], "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def op7_source_mix(spark, sf_dir: str) -> DataFrame:
    return mixed_documents(table(spark, sf_dir, "documents"))
