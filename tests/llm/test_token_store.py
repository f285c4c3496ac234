"""Token files and their index, against plain encoding."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from pyspark.sql import functions as F

from tallyhouse.llm import token_store
from tallyhouse.llm.queries import QUERIES
from tests.llm import brute

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def _docs():
    rng = random.Random(4)
    letters = "abcdefgABCDEFG'.,;!?-0123éÉßİΣσ中̱́ ‍\U0001F600<|>\x1c\x0b"
    docs = [(rng.randint(-50, 400), "".join(rng.choice(letters + " \t\n" * 3) for _ in range(rng.randint(0, 120)))) for _ in range(500)]
    docs += [(None, "no id"), (None, "no id either"), (900, None), (901, ""), (902, " \n "), (903, "x" * 50_000), (904, "It's John's.. don't! H̱. H̱, <|endoftext|> " * 800)]
    docs += [(905, "the same row")] * 2500 + [(906, f"one id, many texts {i}") for i in range(300)]
    return docs


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    docs, folder = _docs(), str(tmp_path_factory.mktemp("tokens"))
    spark.createDataFrame([(*d, 1, 2, "x") for d in docs], "doc_id long, text string, start int, part int, bucket string").repartition(5).write.parquet(f"{folder}/documents.parquet")
    return folder, docs


def test_files_hold_all_ids_in_order(spark, corpus):
    got = [tuple(r) for r in QUERIES["op11_token_ids"](spark, corpus[0]).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert ordered(got) == ordered(brute.op11(corpus[1], WORDS))


def test_small_shards_wide_ids_and_keyed_access(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    vocabulary = token_store.Vocabulary(BYTES, end_id=50256, width=4)
    store = token_store.write_store(docs, f"{tmp_path}/store", vocabulary, shard_ids=500, bucket_keys=50)
    want = brute.op11(corpus[1], BYTES, 50256)
    assert ordered(map(tuple, token_store.tokenised(docs, store).collect())) == ordered(want)
    assert store.buckets > 3 and store.places.select("part", "file").distinct().count() > 50
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    texts = dict(corpus[1])
    ids = token_store.ids_of(spark, store, [903, 904, 12345, None])
    assert set(ids) == {903, 904, None}
    assert all(ids[i] == [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 50256] for i in (903, 904))


def test_unknown_keys_are_not_found(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    store = token_store.write_store(docs, f"{tmp_path}/store", token_store.Vocabulary(WORDS, 1, 2, by_word=True), bucket_keys=100)
    known = {d[0] for d in corpus[1]}
    found = store.lookup(spark.range(-3000, 3000).select(F.col("id").alias("doc_id")).union(spark.sql("select cast(null as bigint)")))
    assert {r["doc_id"] for r in found.collect()} == known


def test_words_alone_are_words_in_texts():
    encoder = token_store.Encoder(token_store.Vocabulary(WORDS, 1, 2, by_word=True))
    plain = token_store.Encoder(token_store.Vocabulary(WORDS, 1, 2))
    texts = [t or "" for _, t in _docs()[:510]]
    texts += ["".join(token_store.LETTERS), " ".join(a + b for a in token_store.LETTERS for b in "e\u0301.\u00c5")]
    want = [plain(t) for t in texts]
    assert [encoder(t) for t in texts] == want == [encoder(t) for t in texts] and encoder.words.plain("Été")
    other = token_store.Words(Tokenizer.from_file(BYTES), encoder.packed)      # has no such letters
    assert not other.plain("a")


def test_marks_and_capitals_make_no_new_words():
    encoder = token_store.Encoder(token_store.Vocabulary(WORDS, 1, 2, by_word=True))
    plain = token_store.Encoder(token_store.Vocabulary(WORDS, 1, 2))
    marks = [".", ",", "***", "!?", "'", "\u2026", "\u037e", "\u00d7", "\u0301.", "\u0130."]
    texts = ["".join(a + b + c for b in marks) for a in ("Abc", "\u00c9t\u00c9", "\u0178", "\u0130", "7", "") for c in (" ", "\t", "\xa0", "x", "'S ", "")]
    assert encoder.cuts and [encoder(t) for t in texts] == [plain(t) for t in texts]
    encoder.words.clear()
    encoder("one")
    held = len(encoder.words)
    encoder("ONE One, one. oNe*** one")
    assert held == 1 and set(encoder.words) == {b"one", b",", b".", b"***"}


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-2**63, 2**63, n, dtype=np.int64))
    hashed = token_store.PerfectHash.build(keys)
    assert sorted(hashed.find(keys).tolist()) == list(range(len(keys)))
    few = token_store.PerfectHash.build(keys, room=0.5, levels=2)         # the rest is listed
    assert sorted(few.find(keys).tolist()) == list(range(len(keys)))
    if n >= 1000:
        assert 64 * len(hashed.bits) < 5 * n


def test_index_part_round_trip():
    keys = np.arange(0, 3000, 3)
    entries = np.zeros(len(keys), token_store._ENTRY)
    entries["print"], entries["offset"] = token_store._fingerprint(keys), keys * 7
    part = token_store.IndexPart.unpack(token_store.IndexPart.build(5, keys, entries, entries[:0]).pack() + b"\n")
    ok, got = part.lookup(np.arange(3000), np.zeros(3000, bool))
    assert part.bucket == 5 and (np.flatnonzero(ok) == keys).all() and (got["offset"] == keys * 7).all()
