"""Exact duplicates through content-defined chunk recipes.

Every text, lower-cased in A-Z, is cut where a rolling hash of its bytes says so. A
document becomes its recipe: the ordered list of chunk digests. Chunk bytes cross the
network once, already without repeats within a task, to verify that a digest stands for
one byte string; a digest that stands for several gets an ordinal per string. From there
on only recipes are moved and compared, never documents.

* A null text counts as empty; all empty texts are equal (one empty chunk).
* Of equal texts the row with the largest ``doc_id`` stays; null ids lose to any id.
* Of rows repeated with id and text alike one stays, the others do not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyhouse.llm.common import join_hot, prepare, settle, table, texts

#: Bytes of a chunk: at least, at most; a cut is due every 2**MEAN_BITS bytes on average.
LEAST, MOST, MEAN_BITS = 256, 16384, 11


def _gear() -> np.ndarray:
    """A 32-bit value for each byte, from a multiplicative rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def cuts(data: bytes, least: int = LEAST, most: int = MOST, bits: int = MEAN_BITS) -> list[int]:
    """Ends of the chunks of ``data``. A cut depends on the 16 bytes before it only,
    but for the least and the most a chunk may have."""
    if len(data) <= least:
        return [len(data)]
    h = _gear()[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    mask = np.uint32(((1 << bits) - 1) << (32 - bits))
    ends, last = [], 0
    for at in (np.flatnonzero((h & mask) == 0) + 1).tolist():
        while at - last > most:
            last += most
            ends.append(last)
        if at - last >= least:
            ends.append(at)
            last = at
    while len(data) - last > most:
        last += most
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends


def _chunks(text: str) -> tuple[bytes, list[bytes]]:
    data = text.encode().lower()
    ends = cuts(data)
    return data, [data[a:b] for a, b in zip([0, *ends], ends)]


def _digest(chunk: bytes, size: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk)[:size]


def recipes(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """``doc_id``, ``h``, ``text_sha256`` of the lower-cased text, ``recipe``: chunk digests in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, lists = [], []
            for text in batch["text"].to_pylist():
                data, chunks = _chunks(text)
                shas.append(hashlib.sha256(data).hexdigest())
                lists.append([_digest(c, digest_bytes) for c in chunks])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["h"], pa.array(shas, pa.string()), pa.array(lists, pa.list_(pa.binary()))],
                names=["doc_id", "h", "text_sha256", "recipe"])

    return texts(docs).mapInArrow(cut, "doc_id long, h long, text_sha256 string, recipe array<binary>")


def chunk_bytes(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """One row per chunk: ``doc_id``, ``h``, ``seq``, ``digest``, ``data``; few MB to a batch."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "h", "seq", "digest", "data"]
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc_id, h, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "h", "text"))):
                for seq, chunk in enumerate(_chunks(text)[1]):
                    rows.append((doc_id, h, seq, _digest(chunk, digest_bytes), chunk))
                    size += len(chunk)
                if size > 4_000_000:
                    yield _batch(rows, names)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, names)

    return texts(docs).mapInArrow(cut, "doc_id long, h long, seq long, digest binary, data binary")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def identified(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """``doc_id``, ``h``, ``text_sha256`` and ``ids``: the recipe in verified identifiers."""
    listed = settle(recipes(docs, digest_bytes))
    chunks = chunk_bytes(docs, digest_bytes)
    strings = chunks.select("digest", "data").dropDuplicates()
    shared = settle(strings.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"))
    as_is = listed.select("doc_id", "h", "text_sha256", F.array_join(F.transform("recipe", F.hex), "").alias("ids"))
    if shared.isEmpty():
        return as_is
    # Some digest stands for several byte strings: the documents that use it get ordinals.
    several = strings.join(shared, "digest", "left_semi")
    ordinal = several.select("digest", "data", F.row_number().over(W.partitionBy("digest").orderBy("data")).alias("n"))
    users = listed.select("doc_id", "h", F.explode("recipe").alias("digest")).join(shared, "digest", "left_semi").select("doc_id", "h").distinct()
    own = users.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h"))
    parts = chunks.dropDuplicates(["doc_id", "h", "seq"]).join(own, on, "left_semi").join(ordinal, ["digest", "data"], "left")
    label = F.concat(F.hex("digest"), F.coalesce(F.concat(F.lit("."), F.col("n").cast("string"), F.lit(";")), F.lit("")))
    fixed = parts.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("seq", label.alias("id")))).alias("p"))
    fixed = fixed.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), F.array_join(F.col("p.id"), "").alias("fixed"))
    return as_is.join(fixed, on, "left").select("doc_id", "h", "text_sha256", F.coalesce("fixed", "ids").alias("ids"))


def exact_duplicates(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """One row per document: ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    prepare(docs.sparkSession)
    rows = identified(docs, digest_bytes).groupBy("doc_id", "text_sha256", "ids").agg(F.count("*").alias("copies"))
    rows = settle(rows)
    groups = settle(rows.groupBy("ids").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count("*").alias("rows")))
    out = join_hot(rows, groups, "ids", "rows", ["doc_id"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP5_SQL = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from d
"""
