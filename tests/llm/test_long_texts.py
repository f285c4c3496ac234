"""Texts with very many matches, and few labels."""

import hashlib
import time

import numpy as np
import pytest

from tallyhouse.llm import pii, secrets, toxicity
from tallyhouse.llm.spans import listed
from tests.llm import brute
from pyspark.sql import functions as F


def sha_of(spans):
    return hashlib.sha256(spans.encode()).hexdigest()


def test_fifty_thousand_addresses_in_one_text(spark):
    text = " ".join(f"10.0.{i % 256}.{i % 199} - u{i}@example.org [ref {i}x]" for i in range(50_000))
    docs = spark.createDataFrame([(1, text), (2, "write to a@b.org")], "doc_id long, text string")
    began = time.time()
    rows = pii.personal(docs).select("doc_id", listed(F.col("base")).alias("base")).collect()
    assert time.time() - began < 120
    assert {r["doc_id"]: sha_of(r["base"]) for r in rows} == {r[0]: r[5] for r in brute.base_spans([(1, text), (2, "write to a@b.org")], brute.PII_KINDS)}


def test_fifty_thousand_assignments_in_one_text(spark):
    text = "\n".join(f"token = value{i:06d}Qw" for i in range(50_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    rows = secrets.secrets(docs, F.lit("o"), F.lit("r")).select(listed(F.col("base")).alias("base"), F.size("spans").alias("n")).collect()
    assert time.time() - began < 120
    assert sha_of(rows[0]["base"]) == brute.base_spans([(1, text)], brute.SECRET_KINDS)[0][4] and rows[0]["n"] == 100_000


def test_outermost_and_outside_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        n = int(rng.integers(0, 400 if i < 5 else 12))
        starts, sizes = rng.integers(0, 60 + 2 * n, n), rng.integers(1, 12, n)
        base = sorted({(int(a), int(o), int(a + b), "k", "v") for a, b, o in zip(starts, sizes, rng.integers(0, 4, n))})
        tokens = [(int(a), int(a + b), "t", int(a)) for a, b in zip(rng.integers(0, 60 + 2 * n, n), rng.integers(1, 9, n))]
        rows.append((i, base, tokens))
    df = spark.createDataFrame(rows, "id int, base array<struct<start:bigint,order:int,end:bigint,kind:string,value:string>>, tokens array<struct<start:bigint,end:bigint,value:string,from:bigint>>")
    got = df.select("id", pii.outermost(F.col("base")).alias("o"), pii.outside(F.col("tokens"), F.col("base")).alias("t")).collect()
    for r, (_, base, tokens) in zip(sorted(got), rows):
        inside = [s for s in base if any(b[0] <= s[0] and b[2] >= s[2] and (b[2] - b[0] > s[2] - s[0] or b[1] < s[1]) for b in base)]
        assert sorted(map(tuple, r["o"])) == [s for s in base if s not in inside]
        assert sorted(map(tuple, r["t"])) == sorted(t for t in tokens if not any(b[0] < t[1] and b[2] > t[0] for b in base))


@pytest.mark.parametrize("n,bad", [(0, 0), (2, 1), (9, 2), (9, 3), (9, 9), (9, 0), (100, 20)])
def test_scores_of_few_labels_are_chances(spark, n, bad):
    ids = [r[0] for r in spark.range(400).filter("crc32(cast(id as string)) % 4 != 2").limit(n).collect()]
    docs = spark.createDataFrame([(i, f"word{i} and more {'vile' if k < bad else 'kind'}{i % 3}") for k, i in enumerate(ids)] + [(1000, "no label"), (1001, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(k < bad)) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and len(scores) == n + 2
    if bad in (0, n):
        assert scores[1000] == pytest.approx((bad + 0.1) / (n + 1))
    if (n, bad) == (100, 20):
        assert all((scores[i] >= 0.3) == (k < bad) for k, i in enumerate(ids))
