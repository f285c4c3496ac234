"""Importance resampling towards a target distribution.

Words and word runs are hashed into buckets. The buckets of all documents and of the
target are counted; a bucket's gain is the logarithm of how much more the target uses it.
A document's weight is the mean gain of its features, read from one array; seeded Gumbel
noise is added, so the highest scores are a draw without replacement by weight.

The cut-off is found without ordering all scores: a quantile sketch gives a bracket about
it, exact counts of the rows above and inside say whether the cut-off is in there, or the
bracket is widened until it is; only the bracket is ordered. The rows drawn are ordered
for their ranks in ranges, by many tasks.

* A null text has no features and weight 0. A null id is hashed as the empty text and
  comes last among equal scores; then the hash of the text decides.
* Repeated rows are counted; each is a row of the result, with a rank of its own.
* With an empty target, or no documents, gains follow from the counts as they are.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyhouse.llm.common import prepare, settle, table, texts

BUCKETS, RUN, SEED = 10_000, 1, 2024
#: Percent drawn of the documents with at least so many words.
PERCENT, LEAST_WORDS = 10, 20
#: Rows the bracket should hold at most, about; the sketch is made as fine as that takes.
BRACKET_ROWS = 100_000
#: Features whose bucket a task remembers.
REMEMBERED = 400_000

#: A-Z to lower case; ASCII that is no digit and no letter to a blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


class Hashed(dict):
    """Bucket of each feature."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def features(text: str, run: int, hashed: Hashed) -> tuple[np.ndarray, int]:
    """Buckets of all runs of 1 to ``run`` words of a text, and its number of words."""
    words = text.encode().translate(_PLAIN).split()
    found = [np.fromiter(map(hashed.__getitem__, words), np.int64, len(words))]
    for n in range(2, run + 1):
        runs = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
        found.append(np.fromiter(map(hashed.__getitem__, runs), np.int64, len(runs)))
    return np.concatenate(found), len(words)


def bucket_counts(docs: DataFrame, buckets: int, run: int) -> np.ndarray:
    """How often each bucket occurs in all texts; ``buckets`` sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, total = Hashed(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                total += np.bincount(features(text, run, hashed)[0], minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    counted = docs.select(text).mapInArrow(count, "bucket long, n long")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much more the target uses each bucket, floored."""
    n, s, t = float(len(own)), float(own.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)))) for a, b in zip(own.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel draw that depends on the id alone, floored."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, run: int = RUN, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``h``, ``words``, ``n_features``, ``weight``, ``score``; rows don't move."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)    # one number a bucket

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        hashed = Hashed(len(gain))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                found, words = features(text, run, hashed)
                weight = int(gain[found].sum()) // len(found) if len(found) else 0
                rows.append((words, len(found), weight, weight + noise(doc_id, seed)))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["h"], *columns], names=["doc_id", "h", "words", "n_features", "weight", "score"])

    return texts(docs).mapInArrow(weigh, "doc_id long, h long, words long, n_features long, weight long, score long")


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("h")]


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``before``: the copies that come before each row. Rows are dealt in
    ranges of the whole order, so neither equal scores nor one id meet in one task."""
    dealt = settle(rows.repartitionByRange(*_order()).withColumn("range", F.spark_partition_id()))
    sums = dealt.groupBy("range").agg(F.sum("copies").alias("n"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)      # one row a range
    sums = sums.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("range").orderBy(*_order()).rowsBetween(W.unboundedPreceding, -1)
    placed = dealt.join(F.broadcast(sums), "range")
    return placed.withColumn("before", F.col("offset") + F.coalesce(F.sum("copies").over(inside), F.lit(0))).drop("range", "offset")


def bracket(rows: DataFrame, total: int, drawn: int, width: float, bracket_rows: int = BRACKET_ROWS) -> tuple[int | None, int | None, int]:
    """Scores between which the cut-off lies (none: no bound), and the copies above them."""
    accuracy = max(10_000, 4 * total // bracket_rows)
    at = 1 - drawn / total
    while True:
        ends = [max(at - width, 0.0), min(at + width, 1.0)]
        low, high = rows.select(F.percentile_approx("score", ends, accuracy).alias("p")).first()["p"]
        low, high = low if ends[0] > 0 else None, high if ends[1] < 1 else None
        over = F.col("score") > high if high is not None else F.lit(False)
        under = F.col("score") < low if low is not None else F.lit(False)
        sums = [F.coalesce(F.sum(F.when(c, F.col("copies"))), F.lit(0)) for c in (over, under)]
        above, below = rows.select(*sums).first()
        if above < drawn <= total - below:
            return low, high, int(above)
        width *= 4


def cut_off(rows: DataFrame, drawn: int, total: int, bracket_rows: int = BRACKET_ROWS) -> tuple[int, int | None, int]:
    """Score, id and hash of the last row drawn."""
    low, high, above = bracket(rows, total, drawn, min(0.25, max(2e-4, bracket_rows / (4 * total))), bracket_rows)
    inside = rows
    if low is not None:
        inside = inside.filter(F.col("score") >= low)
    if high is not None:
        inside = inside.filter(F.col("score") <= high)
    need = drawn - above
    last = in_order(inside).filter((F.col("before") < need) & (F.col("before") + F.col("copies") >= need)).first()
    return last["score"], last["doc_id"], last["h"]


def resample(docs: DataFrame, target: DataFrame, percent: Fraction | int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, run: int = RUN, seed: int = SEED, bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """Every row of ``docs``: ``doc_id``, ``n_features``, ``weight``, ``score`` and, if drawn, ``rank``."""
    prepare(docs.sparkSession)
    gain = gains(bucket_counts(docs, buckets, run), bucket_counts(target, buckets, run))
    found = scored(docs, gain, run, seed)
    rows = settle(found.groupBy(*found.columns).agg(F.count("*").alias("copies")))
    fit = rows.filter(F.col("words") >= least_words)
    total = int(fit.agg(F.sum("copies")).first()[0] or 0)
    drawn = math.floor(percent * total / 100) if isinstance(percent, Fraction) else percent * total // 100
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    columns = ["doc_id", "n_features", "weight", "score"]
    if not drawn:
        return rows.select(*columns, copy).withColumn("rank", F.lit(None).cast("long")).drop("copy")
    score, doc_id, h = cut_off(fit, drawn, total, bracket_rows)
    same = F.col("doc_id").eqNullSafe(F.lit(doc_id)) & (F.col("h") <= h)
    earlier = F.col("doc_id").isNotNull() if doc_id is None else F.coalesce(F.col("doc_id") < doc_id, F.lit(False))
    taken = (F.col("words") >= least_words) & ((F.col("score") > score) | (F.col("score") == score) & (earlier | same))
    rank = F.col("before") + F.col("copy")                       # the last row's copies may be drawn in part
    ranked = in_order(rows.filter(taken)).select(*columns, "before", copy).withColumn("rank", F.when(rank <= drawn, rank)).drop("before", "copy")
    return ranked.unionByName(rows.filter(~taken).select(*columns, copy).withColumn("rank", F.lit(None).cast("long")).drop("copy"))


def op12_importance_resample(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
