"""Token ids of documents in binary files, with a minimal perfect hash index over their keys.

*Shards.* Documents are dealt by range of id, ordered and encoded, a task after another in
ascending order. A shard file holds the raw ids of its documents one after another (little
endian, 2 bytes where the vocabulary allows it, else 4), behind them a directory (ids of
the documents, nulls, ends) and a footer. Spark's text writer puts the bytes down, one
file a shard, so files are committed like any other output, in any store.

*Index.* Keys are dealt over buckets by hash. For each bucket a minimal perfect hash (a
cascade of bit arrays, each taking the keys that are alone at their place) numbers its
keys; an entry a number holds a fingerprint, the shard, the offset, the length, the running
number of the document, and how many documents have that key. A lookup hashes the key,
reads one entry and compares the fingerprint: constant time, whatever the corpus.

* A null text counts as empty: its end id alone. Null ids come last and have a key too.
* Documents of one id are ordered by the hash of their text; they follow each other, and
  the index has one entry for them with their number.
* No documents: no shards, an empty index, no rows.
* Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyhouse.llm.common import prepare, settle, table, texts
from tallyhouse.session import shared_dir

#: Ids to a shard, about, and keys to a bucket of the index, about.
SHARD_IDS, BUCKET_KEYS = 8_000_000, 16_384
#: Words whose ids a worker remembers, and as many met before those.
REMEMBERED = 250_000
#: Letters that are composed already, stand for themselves and have one lower case; marks at a word's end.
LETTERS = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x130), *range(0x139, 0x180)) if c not in (0xD7, 0xF7)]
MARKS = (b".", b",", b";", b":", b"!", b"?")
#: ASCII marks at a word's end, behind a digit or a small letter up to U+017F: a piece of their own.
#: (U+00D7 and U+00F7 are no letters, U+0130 ends in a mark once in lower case.)
ENDING = re.compile(
    rb"([!-/:-@\[-`{-~])((?:(?<=[a-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].)|(?<=\xc4[\x80-\xaf\xb1-\xbf].)|(?<=\xc5[\x80-\xbf].))"
    rb"[!-/:-@\[-`{-~]*)(?=[ \t-\r]|\Z)"
)
#: Bytes that U+0300 to U+037F begin with: marks there are composed with an ASCII letter before them.
COMPOSING = (b"\xcc", b"\xcd")
TRIED_TEXTS = ("Zebra, \u00c9T\u00c9!? A's. x*** 3.14: (So)", "stra\u00dfe;\ta\u0142.\nDon'T!! \u0178... E\u0301. Nai\u0308ve, I\u0307! \u0130. \u00d7.")
TRIED = ("a", "Zebra", "\u00c9clair", "\u00fcber", "stra\u00dfe", "na\u00efvet\u00e9s", "unbelievably", "\u017e\u0101", "qwrtzp" * 9)
#: Bits of a level of the hash for each key still without a place; levels before the rest is listed.
ROOM, LEVELS = 2.0, 40

# The file formats.
SHARD, INDEX, TRAILER = b"idshard1", b"idindex1", "\n"
_FOOTER = "<8sIIIIQQ"                        # mark, bytes an id, task, file of the task, 0, documents, ids
_ENTRY = np.dtype([("print", "<u4"), ("part", "<u4"), ("file", "<u4"), ("n", "<u4"), ("offset", "<u8"), ("number", "<u8"), ("documents", "<u8")])


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer's file, the id behind each document, and the bytes an id takes.

    ``by_word``: words between ASCII blanks are encoded by themselves, each once a task.
    That is exact for tokenizers that drop white space before they split a text further."""

    path: str
    end_id: int
    width: int
    by_word: bool = False


class Words(dict):
    """Bytes of the ids of words, each encoded when it is first met.

    A word of nothing but Latin letters is one piece to the tokenizer, and each of its
    letters is normalised by itself: its pieces are put together from those of its letters
    and go straight to the tokenizer's model. All other words take the whole way. Whether
    that holds for this tokenizer is tried on ``TRIED`` first."""

    def __init__(self, tokenizer, packed):
        super().__init__()
        self.tokenizer, self.packed, self.older = tokenizer, packed, {}
        self.letters = {}
        for c in LETTERS:
            pieces = tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(c)) if tokenizer.normalizer and tokenizer.pre_tokenizer else []
            if len(pieces) == 1:
                self.letters[ord(c)] = pieces[0][0]
        self.plain = re.compile(f"[{''.join(map(chr, self.letters)) or 'a'}]+").fullmatch
        if not self.letters or any(self.quick(w) != self.slow(w) for w in TRIED):
            self.plain = lambda word: None

    def quick(self, word: str) -> bytes:
        return self.packed([t.id for t in self.tokenizer.model.tokenize(word.translate(self.letters))])

    def slow(self, word: str) -> bytes:
        return self.packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def __missing__(self, key: bytes) -> bytes:
        found = self.older.pop(key, None)
        if found is None:
            core, tail = _stem(key)
            if tail or core != key:
                found = self[core] + self[tail] if tail else self[core]
            else:
                word = core.decode()
                found = self.quick(word) if self.plain(word) else self.slow(word)
        if len(self) >= REMEMBERED:          # words not met again since the last time go
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class Encoder:
    """Bytes of the ids of texts."""

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.v = vocabulary
        self.tokenizer = Tokenizer.from_file(vocabulary.path)
        self.tokenizer.encode_special_tokens = True
        self.code = next(c for c in "HIL" if array(c).itemsize == vocabulary.width)
        if sys.byteorder != "little":
            raise NotImplementedError("token files are little endian")
        self.end = self.packed([vocabulary.end_id])
        self.words = Words(self.tokenizer, self.packed) if vocabulary.by_word else None
        self.cuts = self.words is not None and all(self.by_words(_cut(t.encode())) == self.whole(t) for t in TRIED_TEXTS)

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def by_words(self, text: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, text.split()))

    def __call__(self, text: str) -> bytes:
        if self.words is None:
            return self.whole(text) + self.end
        return self.by_words(_cut(text.encode()) if self.cuts else text.encode()) + self.end


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """The encoder of this Python process. Spark keeps worker processes from task to task,
    but what travels to them by value is new each time; so the words already met are kept
    with the tokenizer's own module."""
    import tokenizers

    kept, name = vars(tokenizers).setdefault("_kept_encoders", {}), str(vocabulary)
    if name not in kept:
        kept[name] = Encoder(vocabulary)
    return kept[name]


def _cut(text: bytes) -> bytes:
    """The text with marks at the ends of words set apart, and in lower case where no letter is
    composed with what follows: one word then stands for its forms, and fewer are remembered.
    Whether that holds for this tokenizer is tried on ``TRIED_TEXTS`` first."""
    if not any(b in text for b in COMPOSING):
        text = text.lower()
    return ENDING.sub(rb" \1\2", text)


def _stem(word: bytes) -> tuple[bytes, bytes]:
    """A word's part that ids are looked up for, and one mark at its end that is a token of
    its own behind an ASCII letter or digit. Pure ASCII is lower-cased, as the tokenizer does;
    other words are left to it, since it composes letters before it lower-cases them."""
    if word.isascii():
        word = word.lower()
    if word[-1:] in MARKS and word[-2:-1].isalnum():
        return word[:-1], word[-1:]
    return word, b""


# --- shards -----------------------------------------------------------------------------

def _shard(payload: list[bytes], ids: list, width: int, part: int, file: int) -> bytes:
    ends = np.cumsum([len(p) // width for p in payload], dtype=np.uint64)
    keys = np.array([i or 0 for i in ids], "<i8")
    nulls = np.array([i is None for i in ids], "u1")
    footer = struct.pack(_FOOTER, SHARD, width, part, file, 0, len(ids), int(ends[-1]))
    return b"".join([*payload, keys.tobytes(), nulls.tobytes(), ends.astype("<u8").tobytes(), footer])


def read_shard(content: bytes) -> tuple[int, int, np.ndarray, list, np.ndarray]:
    """Task and file number, ids of all documents in a row, their keys, and their ends."""
    mark, width, part, file, _, documents, n = struct.unpack_from(_FOOTER, content, len(content) - len(TRAILER) - struct.calcsize(_FOOTER))
    if mark != SHARD:
        raise ValueError("not a shard of token ids")
    at = n * width
    keys = np.frombuffer(content, "<i8", documents, at)
    nulls = np.frombuffer(content, "u1", documents, at + 8 * documents)
    ends = np.frombuffer(content, "<u8", documents, at + 9 * documents)
    return part, file, np.frombuffer(content, f"<u{width}", n), [None if x else k for k, x in zip(keys.tolist(), nulls.tolist())], ends


def _put_down(blobs: DataFrame, folder: str) -> None:
    """Each row's bytes as one file, whose name has the task's number and the row's."""
    out = blobs.select(F.col("blob").cast("string").alias("value"))
    out.write.option("maxRecordsPerFile", 1).option("lineSep", TRAILER).option("compression", "none").text(folder)


def _files(spark: SparkSession, folder: str, names: str = "*") -> DataFrame:
    """``content`` of the files that hold any; batches of them stay small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"part-{names}.txt").load(folder)
    return files.filter("length > 0").select("content")


def write_shards(docs: DataFrame, folder: str, vocabulary: Vocabulary, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` in ascending order of ids into shard files."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("h")]
    dealt = texts(docs).repartitionByRange(*order).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, file, width = encoder_of(vocabulary), TaskContext.get().partitionId(), 0, vocabulary.width
        payload: list[bytes] = []
        ids: list = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                got = encoder(text)
                if payload and held + len(got) > shard_ids * width:
                    yield pa.RecordBatch.from_arrays([pa.array([_shard(payload, ids, width, part, file)], pa.binary())], names=["blob"])
                    payload, ids, held, file = [], [], 0, file + 1
                payload.append(got)
                ids.append(doc_id)
                held += len(got)
        if payload:
            yield pa.RecordBatch.from_arrays([pa.array([_shard(payload, ids, width, part, file)], pa.binary())], names=["blob"])

    _put_down(dealt.select("doc_id", "text").mapInArrow(encode, "blob binary"), folder)


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in the shards, read from them: ``part``, ``file``, ``row``, ``doc_id``,
    ``offset`` (in the shard), ``n_tokens``, ``ids_crc32``, ``number`` (all documents before
    it) and ``start`` (all ids before it)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "file", "row", "doc_id", "offset", "n_tokens", "ids_crc32"]
        for batch in batches:
            for content in batch["content"]:
                part, file, ids, keys, ends = read_shard(content.as_buffer().to_pybytes())
                ends = ends.astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(keys)
                columns = [np.full(n, part), np.full(n, file), np.arange(n), keys, starts, ends - starts, crcs]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    found = settle(_files(spark, folder).mapInArrow(read, "part long, file long, row long, doc_id long, offset long, n_tokens long, ids_crc32 long"))
    shards = found.groupBy("part", "file").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("ids"))
    # What stands before a shard: sums over the tasks before, then over the task's own files.
    tasks = shards.groupBy("part").agg(F.sum("docs").alias("docs"), F.sum("ids").alias("ids"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)          # a row a task
    own = W.partitionBy("part").orderBy("file").rowsBetween(W.unboundedPreceding, -1)

    def sums(c: str, w) -> F.Column:
        return F.coalesce(F.sum(c).over(w), F.lit(0))

    tasks = tasks.select("part", sums("docs", earlier).alias("docs0"), sums("ids", earlier).alias("ids0"))
    shards = shards.select("part", "file", sums("docs", own).alias("docs1"), sums("ids", own).alias("ids1"))
    before = shards.join(tasks, "part").select("part", "file", (F.col("docs0") + F.col("docs1")).alias("docs"), (F.col("ids0") + F.col("ids1")).alias("ids"))
    out = found.join(before, ["part", "file"])
    return out.select(*found.columns, (F.col("docs") + F.col("row")).alias("number"), (F.col("ids") + F.col("offset")).alias("start"))


# --- index ------------------------------------------------------------------------------

def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each key; another one for each level."""
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys, 1000) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Numbers distinct 64-bit keys from 0 without a gap.

    A level is a bit array; keys that are alone at their place in it are settled, the
    others go on to the next. A key's number is the count of bits before its own. What is
    left after the last level is listed."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.firsts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray, room: float = ROOM, levels: int = LEVELS) -> PerfectHash:
        left, sizes, words = keys.astype(np.uint64), [], []
        while len(left) and len(sizes) < levels:
            size = 64 * max(1, int(np.ceil(room * len(left) / 64)))
            at = (_mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[at]]
        bits = np.concatenate(words) if words else np.zeros(0, "<u8")
        return cls(np.array(sizes, "<u8"), bits, np.sort(left))

    @property
    def placed(self) -> int:
        return int(self.ranks[-1])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; of a key it was not built from some number, or -1."""
        keys = keys.astype(np.uint64)
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                return out
            at = self.firsts[level] + (_mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[open_[hit]] = self.ranks[at[hit] >> 6] + below
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            out[open_] = np.where(self.rest[at] == keys[open_], self.placed + at, -1)
        return out


class IndexPart:
    """A bucket of the index: its hash, an entry for each of its keys, and the null key's."""

    def __init__(self, bucket: int, hashed: PerfectHash, entries: np.ndarray, null: np.ndarray):
        self.bucket, self.hashed, self.entries, self.null = bucket, hashed, entries, null

    @classmethod
    def build(cls, bucket: int, keys: np.ndarray, entries: np.ndarray, null: np.ndarray) -> IndexPart:
        hashed = PerfectHash.build(keys)
        own = np.empty(len(keys), _ENTRY)
        own[hashed.find(keys)] = entries
        return cls(bucket, hashed, own, null)

    def pack(self) -> bytes:
        h = self.hashed
        head = struct.pack("<8sQQQQQQ", INDEX, self.bucket, len(h.sizes), len(h.bits), len(h.rest), len(self.entries), len(self.null))
        return head + b"".join(a.tobytes() for a in (h.sizes, h.bits, h.rest.astype("<u8"), self.entries, self.null))

    @classmethod
    def unpack(cls, content: bytes) -> IndexPart:
        mark, bucket, *sizes = struct.unpack_from("<8sQQQQQQ", content)
        if mark != INDEX:
            raise ValueError("not a part of an index")
        at, got = 56, []
        for kind, n in zip(("<u8", "<u8", "<u8", _ENTRY, _ENTRY), sizes):
            got.append(np.frombuffer(content, kind, n, at))
            at += n * np.dtype(kind).itemsize
        return cls(bucket, PerfectHash(*got[:3]), got[3], got[4])

    def lookup(self, keys: np.ndarray, nulls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are in the index, and the entries of those."""
        out = np.zeros(len(keys), _ENTRY)
        at = self.hashed.find(keys)
        ok = (at >= 0) & ~nulls
        ok[ok] = self.entries["print"][at[ok]] == _fingerprint(keys[ok])
        out[ok] = self.entries[at[ok]]
        if len(self.null):
            out[nulls] = self.null[0]
            ok |= nulls
        return ok, out[ok]


def _bucket(buckets: int) -> F.Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).alias("bucket")


def write_index(found: DataFrame, folder: str, bucket_keys: int = BUCKET_KEYS) -> int:
    """Build the index over ``places``; the number of its buckets follows the keys."""
    keys = settle(found.groupBy("doc_id").agg(F.count("*").alias("documents"), F.min(F.struct("number", "part", "file", "offset", "n_tokens")).alias("p")).select("doc_id", "documents", "p.*"))
    buckets = max(1, -(-keys.count() // bucket_keys))

    def build(rows: pa.Table) -> pa.Table:
        doc_ids = rows["doc_id"].combine_chunks()
        null = doc_ids.is_null().to_numpy(zero_copy_only=False)
        own = doc_ids.fill_null(0).to_numpy()
        entries = np.zeros(len(own), _ENTRY)
        entries["print"] = _fingerprint(own)
        for field, column in (("part", "part"), ("file", "file"), ("n", "n_tokens"), ("offset", "offset"), ("number", "number"), ("documents", "documents")):
            entries[field] = rows[column].to_numpy()
        built = IndexPart.build(rows["bucket"][0].as_py(), own[~null], entries[~null], entries[null])
        return pa.table({"blob": pa.array([built.pack()], pa.binary())})

    _put_down(keys.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInArrow(build, "blob binary"), folder)
    return buckets


_FOUND = "doc_id long, part long, file long, n long, offset long, number long, documents long"


def lookup(keys: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Entries of the ``doc_id`` values in ``keys`` that the index has, each asked once."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                blob = content.as_buffer().to_pybytes()
                yield pa.RecordBatch.from_arrays([pa.array([IndexPart.unpack(blob).bucket], pa.int64()), pa.array([blob], pa.binary())], names=["bucket", "blob"])

    def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
        doc_ids = asked["doc_id"].combine_chunks()
        nulls = doc_ids.is_null().to_numpy(zero_copy_only=False)
        ok, got = np.zeros(len(doc_ids), bool), np.zeros(0, _ENTRY)
        if len(held) and len(doc_ids):
            ok, got = IndexPart.unpack(held["blob"][0].as_py()).lookup(doc_ids.fill_null(0).to_numpy(), nulls)
        names = ["part", "file", "n", "offset", "number", "documents"]
        return pa.table([doc_ids.filter(pa.array(ok)), *(pa.array(got[c].astype(np.int64)) for c in names)], names=["doc_id", *names])

    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().select("doc_id", _bucket(buckets))
    held = _files(keys.sparkSession, folder).mapInArrow(parts, "bucket long, blob binary")
    return asked.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(answer, _FOUND)


# --- the store --------------------------------------------------------------------------

@dataclass(frozen=True)
class Store:
    """Shards and index of one corpus."""

    folder: str
    buckets: int
    places: DataFrame

    def lookup(self, keys: DataFrame) -> DataFrame:
        return lookup(keys, f"{self.folder}/index", self.buckets)


def write_store(docs: DataFrame, folder: str, vocabulary: Vocabulary, shard_ids: int = SHARD_IDS, bucket_keys: int = BUCKET_KEYS) -> Store:
    """Write ``docs`` into ``folder``: shards, then the index over what the shards hold."""
    spark = prepare(docs.sparkSession)
    write_shards(docs, f"{folder}/shards", vocabulary, shard_ids)
    found = settle(places(spark, f"{folder}/shards"))
    return Store(folder, write_index(found, f"{folder}/index", bucket_keys), found)


def ids_of(spark: SparkSession, store: Store, doc_ids: list[int | None]) -> dict:
    """Ids of some documents, for inspection: of each id's first one. Only the shards that
    hold them are read."""
    asked = spark.createDataFrame([(i,) for i in doc_ids], "doc_id long")
    rows = store.lookup(asked).collect()                       # as many as were asked for
    out = {}
    for part, file in sorted({(r["part"], r["file"]) for r in rows}):
        content = _files(spark, f"{store.folder}/shards", f"{part:05d}-*-c{file:03d}").first()["content"]
        ids = read_shard(bytes(content))[2]
        out |= {r["doc_id"]: ids[r["offset"]:r["offset"] + r["n"]].tolist() for r in rows if (r["part"], r["file"]) == (part, file)}
    return out


def tokenised(docs: DataFrame, store: Store) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, found through the
    index and read from the shards."""
    got = store.lookup(docs).select(F.col("doc_id").alias("asked"), F.col("number").alias("first"), "documents")
    # Many documents of one id are asked for in blocks, by many tasks.
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("documents") - 1, F.lit(1024).cast("long"))).alias("block")
    several = got.filter("documents > 1").select("*", block).repartition("asked", "block")
    each = F.explode(F.sequence(F.col("first") + F.col("block"), F.col("first") + F.least(F.col("block") + 1024, "documents") - 1)).alias("number")
    numbers = got.filter("documents = 1").select("asked", F.col("first").alias("number")).unionByName(several.select("asked", each))
    met = store.places.join(numbers, "number").filter(F.col("doc_id").eqNullSafe(F.col("asked")))
    return met.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_token_ids(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    vocabulary = Vocabulary(public_tokenizers.path("word_bpe_49k.json"), end_id=1, width=2, by_word=True)
    return tokenised(docs, write_store(docs, f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}", vocabulary))
