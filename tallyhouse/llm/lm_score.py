"""Language-model scores from a word-pair model kept in Elias-Fano tries.

The model is split over *shards* by context word, the corpus into *batches* of documents;
both numbers follow the corpus, so neither a shard nor a batch outgrows a task.

1. ``survey`` counts every word once: tokens, vocabulary, and the words so frequent that
   their successors must be dealt out over several shards (at most ``1 / HOT_PART`` words a
   shard), with their counts.
2. Each batch sends the shards it has pairs for one message: its distinct pairs with their
   training counts. A pair is sent once a batch, however often it occurs, and a shard
   without any is sent nothing: messages never outnumber pairs.
3. A shard adds the counts up, builds its trie and asks it every message's pairs, those of
   held-out texts too: exact counts of the contexts, quantised log10 of the first term of
   P(w | v) below. Its second term needs the word alone.
4. Each batch scores its documents with the answers.

P(w | v) = (c(v w) + M * P1(w)) / (c(v) + M), with P1(w) = (c(w) + 1) / (N + V + 1); it sums
to one over the known words and one unknown word, also after an unknown context. Words are
64-bit hashes; successors within a context are told apart by 32 bits.

* A null text counts as empty and scores its end alone. A null id is learned from.
* Repeated rows each get a row and are each learned from.
* With nothing to learn from, N and V are 0 and every token has probability one.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import prepare, settle, table, texts
from tallyhouse.llm.ngram_trie import Trie, dequantise

FOLDS, HELD_OUT = 7, 2
#: Tokens to a batch and to a shard, about.
BATCH_TOKENS, SHARD_TOKENS = 1_000_000, 2_000_000
#: A word is hot from this part of a shard's load.
HOT_PART = 0.25
#: Distinct words a task of the survey holds before it hands them on.
HELD_WORDS = 1_000_000
#: How many tokens the unigram model is worth after a context.
PRIOR = 100.0
START, END = b"\n", b"\n\n"      # no word holds a line end


def word_hash(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


@dataclass
class Survey:
    train_tokens: int
    train_docs: int
    vocabulary: int
    batches: int
    shards: int
    hot: np.ndarray        # hashes of hot words, sorted
    parts: np.ndarray      # over how many shards each is dealt as a context
    counts: np.ndarray     # how often each occurs in training texts


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (its hash), ``n``, ``train`` of every word; ``START`` stands once for every text."""

    def rows(seen: Counter, trained: bool) -> pa.RecordBatch:
        n = pa.array(seen.values(), pa.int64())
        words = pa.array(word_hash(seen).view(np.int64))
        return pa.RecordBatch.from_arrays([words, n, n if trained else pa.array(np.zeros(len(seen), np.int64))], names=["word", "n", "train"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {False: Counter(), True: Counter()}      # by training text or not
        for batch in batches:
            for text, held in zip(batch["text"].to_pylist(), batch["held_out"].to_pylist()):
                own = seen[not held]
                own.update(text.encode().lower().split())
                own[START] += 1
                if len(own) > HELD_WORDS:
                    yield rows(own, not held)
                    own.clear()
        for trained, own in seen.items():
            yield rows(own, trained)

    counted = docs.select("text", "held_out").mapInArrow(count, "word long, n long, train long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("train").alias("train"))


def survey(docs: DataFrame) -> Survey:
    """Totals of the corpus and its hot words. ``START`` is counted as often as ``END`` is,
    so its row stands for that token in all sums."""
    words = settle(word_counts(docs))
    start = int(word_hash([START]).view(np.int64)[0])
    of_start = F.max(F.when(F.col("word") == start, F.col("train"))).alias("docs")
    total = words.agg(F.sum("n").alias("n"), F.sum("train").alias("train"), F.count_if(F.col("train") > 0).alias("words"), of_start).first()
    tokens = int(total["n"] or 0)
    shards = -(-max(tokens, 1) // SHARD_TOKENS)
    hot = words.filter(F.col("n") * shards >= HOT_PART * tokens) if shards > 1 else words.filter("false")
    hot = hot.toArrow()      # bounded: each has HOT_PART of a shard's tokens
    hashes, n, train = (hot[c].to_numpy().astype(np.int64) for c in ("word", "n", "train"))
    hashes = hashes.view(np.uint64)
    order = np.argsort(hashes)
    parts = np.ceil(n * (shards / max(tokens, 1)) / HOT_PART).astype(np.int64)
    return Survey(int(total["train"] or 0), int(total["docs"] or 0), int(total["words"] or 0), -(-max(tokens, 1) // BATCH_TOKENS), shards,
                  hashes[order], np.maximum(parts, 1)[order], train[order])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _part_key(context: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The name a context goes by in its shard; each part of a hot one has its own."""
    return context + part.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)


class Pairs:
    """The distinct pairs of a batch in the order all sides agree on: by shard, context
    hash, successor hash. ``where``: the pair of every token, documents one after another."""

    def __init__(self, texts: list[str], s: Survey):
        index: dict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        ids: list[int] = []
        start, end = index[START], index[END]
        self.sizes = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            words = text.encode().lower().split()
            self.sizes[i] = len(words) + 1
            ids.append(start)
            ids += [index[w] for w in words]
            ids.append(end)
        self.hashes, rank = np.unique(word_hash(index), return_inverse=True)
        self.start, self.end = int(rank[start]), int(rank[end])
        at = rank[np.array(ids, np.int64)]
        first = at != self.end
        code = at[:-1][first[:-1]] * len(self.hashes) + at[1:][first[:-1]] if len(at) else np.zeros(0, np.int64)
        code, where = np.unique(code, return_inverse=True)
        v, w = code // len(self.hashes), code % len(self.hashes)
        # Contexts go to one shard each, hot ones to those of their parts that have a pair here.
        at = np.minimum(np.searchsorted(s.hot, self.hashes), max(len(s.hot) - 1, 0))
        self.hot = s.hot[at] == self.hashes if len(s.hot) else np.zeros(len(self.hashes), bool)
        parts, self.hot_counts = np.ones(len(self.hashes), np.int64), s.counts[at[self.hot]]
        parts[self.hot] = s.parts[at[self.hot]]
        part = (self.hashes[w] % parts[v].astype(np.uint64)).astype(np.int64)
        most = int(parts.max())
        entries, own = np.unique(v * most + part, return_inverse=True)
        entry, entry_part = entries // most, entries % most
        keys = _part_key(self.hashes[entry], entry_part)
        entry_shard = (_mix(keys) % np.uint64(s.shards)).astype(np.int64)
        order = np.argsort(entry_shard, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.entry, self.keys = entry[order], keys[order]
        own = place[own]                                             # the entry of each pair
        order = np.lexsort((w, own))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.v, self.w, self.where = v[order], w[order], back[where]
        self.per_entry = np.bincount(own, minlength=len(self.entry))
        self.shards, first = np.unique(np.sort(entry_shard), return_index=True)
        self.entry_cut = np.append(first, len(self.entry))
        self.pair_cut = np.concatenate([[0], np.cumsum(self.per_entry)])[self.entry_cut]


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(len(a.tobytes()) for a in arrays)], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(a.tobytes() for a in arrays))


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(data, np.int64, len(kinds) + 1)[1:]
    at, out = 8 * (len(kinds) + 1), []
    for kind, size in zip(kinds, sizes.tolist()):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


MESSAGE = (np.uint64, np.uint32, np.uint32, np.uint32, np.int64)     # contexts, successors of each, their hashes, training counts; counts of hot contexts
ANSWER = (np.int64, np.uint16)                             # counts of the contexts, codes of the pairs


def messages(docs: pa.Table, s: Survey) -> pa.Table:
    pairs = Pairs(docs["text"].to_pylist(), s)
    train = np.repeat(~docs["held_out"].to_numpy(), pairs.sizes)
    counts = np.bincount(pairs.where, weights=train, minlength=len(pairs.v)).astype(np.uint32)
    successors = (pairs.hashes[pairs.w] >> np.uint64(32)).astype(np.uint32)
    blobs, hot = [], np.zeros(len(pairs.hashes), np.int64)
    hot[pairs.hot] = pairs.hot_counts
    hot = hot[pairs.entry]
    for a, b, x, y in zip(pairs.entry_cut, pairs.entry_cut[1:], pairs.pair_cut, pairs.pair_cut[1:]):
        blobs.append(_pack(pairs.keys[a:b], pairs.per_entry[a:b].astype(np.uint32), successors[x:y], counts[x:y], hot[a:b]))
    batch = docs["batch"][0].as_py()
    return pa.table({"shard": pa.array(pairs.shards), "batch": pa.array([batch] * len(blobs), pa.int64()), "message": pa.array(blobs, pa.binary())})


def answers(rows: pa.Table, s: Survey) -> pa.Table:
    """One shard: add up, build the trie, answer."""
    got = [_unpack(m, *MESSAGE) for m in rows["message"].to_pylist()]
    contexts, of = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
    sizes = np.concatenate([g[1] for g in got])
    pair = (np.repeat(of, sizes).astype(np.uint64) << np.uint64(32)) | np.concatenate([g[2] for g in got])
    pair, which = np.unique(pair, return_inverse=True)
    counts = np.bincount(which, weights=np.concatenate([g[3] for g in got]), minlength=len(pair)).astype(np.int64)
    context_of = (pair >> np.uint64(32)).astype(np.int64)
    totals = np.bincount(context_of, weights=counts, minlength=len(contexts)).astype(np.int64)
    kept, seen = counts > 0, totals > 0
    whole = totals.copy()                                        # of a hot context, this shard has a part
    np.maximum.at(whole, of, np.concatenate([g[4] for g in got]))
    rank = np.cumsum(seen) - 1
    first = np.searchsorted(rank[context_of[kept]], np.arange(int(seen.sum()) + 1))
    trie = Trie(contexts[seen], first, (pair[kept] & np.uint64(0xFFFFFFFF)), np.log10(counts[kept] / (whole[context_of[kept]] + PRIOR)))
    codes = trie.lookup(trie.context(contexts)[context_of], (pair & np.uint64(0xFFFFFFFF)))[which]
    blobs, at, x = [], 0, 0
    for g in got:
        blobs.append(_pack(totals[of[at:at + len(g[0])]], codes[x:x + len(g[2])]))
        at, x = at + len(g[0]), x + len(g[2])
    return pa.table({"batch": rows["batch"], "shard": rows["shard"], "answer": pa.array(blobs, pa.binary())})


def scores(docs: pa.Table, replies: pa.Table, s: Survey) -> pa.Table:
    pairs = Pairs(docs["text"].to_pylist(), s)
    replies = replies.sort_by("shard")
    got = [_unpack(m, *ANSWER) for m in replies["answer"].to_pylist()]
    contexts = np.zeros(len(pairs.hashes), np.int64)
    contexts[pairs.entry] = np.concatenate([g[0] for g in got])
    contexts[pairs.hot] = pairs.hot_counts
    counts = contexts.copy()                                     # every word of the batch is a context
    counts[pairs.end], counts[pairs.start] = s.train_docs, 0
    one = (counts + 1) / (s.train_tokens + s.vocabulary + 1)
    codes = np.concatenate([g[1] for g in got])
    both = np.where(codes > 0, 10.0 ** dequantise(codes), 0.0)
    chance = np.minimum(1, both + one[pairs.w] * (PRIOR / (contexts[pairs.v] + PRIOR)))    # codes round
    edges = np.concatenate([[0], np.cumsum(pairs.sizes)[:-1]])

    def per_doc(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[pairs.where], edges)

    return pa.table({
        "doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": pa.array(pairs.sizes),
        "n_known": pa.array(per_doc((counts[pairs.w] > 0).astype(np.int64))), "train_tokens": pa.array(np.full(len(pairs.sizes), s.train_tokens)),
        "base_score": pa.array(per_doc(np.log10(one[pairs.w]))), "score": pa.array(per_doc(np.log10(chance)))})


def language_scores(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    prepare(docs.sparkSession)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    plain = texts(docs).select("doc_id", "text", "h", held_out.alias("held_out"))
    s = survey(plain)
    batch = F.expr(f"pmod(xxhash64(doc_id, h), {s.batches}L)")
    # As many partitions as batches and shards: what a task reads does not grow with the corpus.
    dealt = plain.select("doc_id", "text", "held_out", batch.alias("batch")).repartition(s.batches, "batch")
    asked = dealt.groupBy("batch").applyInArrow(lambda t: messages(t, s), "shard long, batch long, message binary").repartition(s.shards, "shard")
    replied = asked.groupBy("shard").applyInArrow(lambda t: answers(t, s), "batch long, shard long, answer binary").repartition(s.batches, "batch")
    return dealt.groupBy("batch").cogroup(replied.groupBy("batch")).applyInArrow(
        lambda d, r: scores(d, r, s),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op10_lm_score(spark, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))
