"""Importance resampling against a plain sort of all scores."""

import random

import pytest

from tallyhouse.llm import resample
from tallyhouse.llm.queries import QUERIES
from tests.llm import brute

FIELDS = ["doc_id", "n_features", "weight", "score", "rank"]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng, folder = random.Random(9), str(tmp_path_factory.mktemp("corpus"))
    words = ["".join(rng.choice("abcdefgé9") for _ in range(rng.randint(1, 6))) for _ in range(400)]

    def prose(n, some):
        return " ".join(rng.choice(some) for _ in range(n))

    docs = [(i, prose(rng.choice([0, 5, 19, 20, 21, 60, 200]), words[:80] if i % 5 == 0 else words)) for i in range(1500)]
    docs += [docs[1]] * 40 + [(7, prose(30, words)) for _ in range(60)] + [(None, prose(25, words)) for _ in range(9)]
    docs += [(9000, None), (9001, ""), (9002, "A,B;c-D \x1f eÉ " * 5000), (9003, "X" * 30_000)] + [(9004, prose(40, words))] * 300
    items = [(i, prose(50, words[:80])) for i in range(20)] + [(None, None), (21, "")]
    spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id long, text string, h int, score int, copies int").repartition(6).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, h int").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, items


def test_draw(spark, corpus):
    folder, docs, items = corpus
    got = ordered(tuple(r) for r in QUERIES["op12_importance_resample"](spark, folder).select(*FIELDS).collect())
    assert got == ordered(brute.op12(docs, items))
    ranks = sorted(r[4] for r in got if r[4] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) > 100


@pytest.mark.parametrize("percent,run,buckets", [(50, 2, 64), (1, 3, 1000), (100, 1, 10), (0, 1, 10)])
def test_other_shares_and_runs(spark, corpus, percent, run, buckets):
    folder, docs, items = corpus
    read = [spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark")]
    got = resample.resample(*read, percent=percent, run=run, buckets=buckets, bracket_rows=50).select(*FIELDS)
    assert ordered(map(tuple, got.collect())) == ordered(brute.op12(docs, items, percent=percent, run=run, buckets=buckets))


def test_bracket_is_widened(spark):
    rows = spark.createDataFrame([(i, i, 1, 1_000_000 if i == 3 else 1) for i in range(1000)], "doc_id long, score long, h long, copies long")
    # The sketch knows nothing of copies: nearly all of them have the score 3.
    low, high, above = resample.bracket(rows, 1_000_999, 500_000, 1e-4)
    assert (low is None or low <= 3) and (high is None or high >= 3)
    assert above < 500_000
    last = resample.cut_off(rows, 500_000, 1_000_999)
    assert last[0] == 3


def test_empty_target(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * 30) for i in range(40)], "doc_id long, text string")
    got = resample.resample(docs, docs.filter("false")).collect()
    assert len(got) == 40 and sum(r["rank"] is not None for r in got) == 4
