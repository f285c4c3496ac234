"""Toxicity by weak supervision.

1. *Voters.* Words (lexicon voters) and word beginnings (pattern voters, written ``^stem``)
   that stand out among labelled toxic or clean texts each become a voter.
2. *Label model.* A generative model of the votes is fitted by EM: for every voter how
   often it fires on toxic and on clean texts (its accuracy), and how strongly it fires
   together with others beyond what the label explains (its correlations). A voter's
   evidence is divided among those it is correlated with. The given label is one more,
   noisy voter with an accuracy of its own.
3. *Classifier.* A linear model over the voters and many more terms is fitted to the
   posterior labels and scores every text.

Labels come from rows whose crc32 of the id as text is not 2 modulo 4. The fit uses at
most ``rows`` of them (a documented bound, chosen by hash among the distinct texts of
each labelled id that is in the table); scoring covers all rows and
whole texts. Neither labels, lang, source nor ids are inputs of a score.

* A null or empty text has no terms and gets the score of a text without any.
* A null id is neither held out nor learned from. Rows of one id share its label; a
  row labelled twice counts as toxic if one of the labels says so.
* Without labels of both kinds there is nothing to learn: every text gets the share of
  toxic labels, (toxic + 0.1) / (rows + 1).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import free, prepare, settle, table

#: Labelled rows the model is fitted to, at most.
ROWS = 20_000
VOTERS, TERMS, STEMS = 48, 2048, (4, 5, 6)
FOLDS, HELD_OUT, LIMIT = 4, 2, 0.3
SEED = 7

#: A-Z to lower case; ASCII that is neither letter nor digit to a blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str) -> set[bytes]:
    """Distinct words, and the beginnings of longer ones marked with ``^``."""
    words = set(text.encode().translate(_PLAIN).split())
    out = set(words)
    for n in STEMS:
        out.update(b"^" + s for s in {w[:n] for w in words if len(w) > n})
    return out


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float

    def score(self, text: str) -> float:
        found = terms_of(text) & self.weights.keys() if self.weights else ()
        return float(1 / (1 + np.exp(-(self.bias + sum(self.weights[t] for t in found)))))


def label_model(votes: np.ndarray, toxic: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Posterior probability of each row to be toxic, given ``votes`` (rows by voters,
    fired or not) and the noisy label."""
    n, k = votes.shape
    fired = votes.astype(np.float64)
    post = np.where(toxic, 0.9, 0.1)
    for _ in range(rounds):
        w = np.stack([1 - post, post])                       # class by row
        size = w.sum(axis=1)
        rate = (w @ fired + 0.5) / (size[:, None] + 1)       # how often each voter fires, by class
        both = np.stack([(fired * w[c][:, None]).T @ fired for c in (0, 1)]) / size[:, None, None]
        spread = np.sqrt(rate * (1 - rate)) + 1e-9
        corr = (both - rate[:, :, None] * rate[:, None, :]) / (spread[:, :, None] * spread[:, None, :])
        tied = np.clip(corr, 0, 1).max(axis=0) ** 2
        np.fill_diagonal(tied, 1)
        share = 1 / tied.sum(axis=1)                         # a voter's own part of the evidence
        label_rate = (w @ toxic.astype(np.float64) + 1) / (size + 2)
        on = np.log(rate[1] / rate[0]) * share
        off = np.log((1 - rate[1]) / (1 - rate[0])) * share
        logit = np.log(size[1] / size[0]) + fired @ on + (1 - fired) @ off
        logit += np.where(toxic, np.log(label_rate[1] / label_rate[0]), np.log((1 - label_rate[1]) / (1 - label_rate[0])))
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        post = np.clip(post, 1e-6, 1 - 1e-6)
    return post


def linear(rows: np.ndarray, cols: np.ndarray, n: int, k: int, target: np.ndarray, rounds: int = 500, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on a sparse 0/1 matrix by accelerated gradient steps."""
    per_row = np.bincount(rows, minlength=n)
    step = 4 / (1 + np.percentile(per_row, 90))
    w, bias, last_w, last_b = np.zeros(k), 0.0, np.zeros(k), 0.0
    for i in range(rounds):
        m = i / (i + 3)
        at_w, at_b = w + m * (w - last_w), bias + m * (bias - last_b)
        z = np.bincount(rows, weights=at_w[cols], minlength=n) + at_b
        gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        last_w, last_b = w, bias
        w = at_w - step * (np.bincount(cols, weights=gap[rows], minlength=k) / n + ridge * at_w)
        bias = at_b - step * gap.mean()
    return w, float(bias)


def seen_in(rows: int) -> int:
    """In how many sample texts a term must occur: one in a hundred, from 2 to 8."""
    return min(8, max(2, rows // 100))


def labelled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``text`` and ``toxic`` of at most ``rows`` labelled rows outside the held-out fold."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    ids = ids.filter(F.col("toxic").isNotNull() & (crc % FOLDS != HELD_OUT)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    # The bound is put on documents met by a label, each text of an id once. Keys are drawn
    # first, so that texts are joined with at most ``rows`` of them.
    keys = own.select("doc_id", "h").distinct().join(ids, "doc_id")
    keys = settle(keys.orderBy(F.xxhash64(F.lit(SEED), "doc_id", "h"), "doc_id", "h").limit(rows))
    met = own.join(F.broadcast(keys), ["doc_id", "h"])   # at most ``rows`` small rows
    return met.groupBy("doc_id", "h").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    """Learn voters, label model and classifier; all statistics come from Spark jobs over
    the sample, the driver holds term indexes of at most ``rows`` texts."""
    spark = prepare(docs.sparkSession)
    sample = labelled(docs, labels, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bad, n = Counter(), Counter(), [0, 0]
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                found = terms_of(text)
                seen.update(found)
                n[toxic > 0] += 1
                if toxic:
                    bad.update(found)
        keys = [b"", *seen]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array([sum(n), *seen.values()], pa.int64()), pa.array([n[1], *(bad[t] for t in seen)], pa.int64())],
            names=["term", "n", "bad"])

    counts = sample.mapInArrow(count, "term binary, n long, bad long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    counts = settle(counts)
    total = counts.filter(F.length("term") == 0).first()
    n, bad = (int(total["n"] or 0), int(total["bad"] or 0)) if total else (0, 0)
    if not 0 < bad < n:
        return Model({}, float(np.log((bad + 0.1) / (n - bad + 0.9))))
    counts = counts.filter(F.col("n") >= seen_in(n))
    p = bad / n
    z = (F.col("bad") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p) + 1)
    ranked = counts.filter(F.length("term") > 0).select("term", z.alias("z"))
    top = [bytes(r["term"]) for r in ranked.orderBy(F.abs("z").desc(), "term").limit(TERMS).collect()]
    voters = top[:VOTERS]
    index = {t: i for i, t in enumerate(top)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(index[t] for t in terms_of(x) & index.keys()) for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch["toxic"].cast(pa.int32())], names=["terms", "toxic"])

    seen = sample.mapInArrow(look, "terms array<int>, toxic int").toArrow()
    lists = seen["terms"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    cols, rows_of = lists.flatten().to_numpy(), np.repeat(np.arange(len(seen)), sizes)
    order = np.lexsort((cols, rows_of))
    cols, rows_of = cols[order], rows_of[order]
    votes = np.zeros((len(seen), len(voters)), bool)
    own = cols < len(voters)
    votes[rows_of[own], cols[own]] = True
    posterior = label_model(votes, seen["toxic"].to_numpy() > 0)
    weights, bias = linear(rows_of, cols, len(seen), len(top), posterior)
    return Model({t: float(x) for t, x in zip(top, weights) if x}, bias)


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with one more column, the score of the whole ``text``; rows don't move."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # at most TERMS weights
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores = pa.array([m.score(t or "") for t in batch["text"].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns."""
    name, = free(docs, "__score")
    return scored(docs, fit(docs, labels), name).filter(F.col(name) < limit).drop(name)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), fit(docs, labels))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= LIMIT, 1).otherwise(0).alias("predicted"))
