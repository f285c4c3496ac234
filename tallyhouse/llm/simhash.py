"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint is mapped to the number of set bits in each of its 32 two-bit segments.
The Manhattan distance of two such count vectors never exceeds the Hamming distance of
the fingerprints, so all links lie within Manhattan distance 4. The 32 dimensions are
cut into 8 groups; four differing bits leave at least four groups untouched, so two
linked vectors share a grid cell (of side one) in the projection to some four groups.
Rows meet by cell; within a cell the Manhattan distance is tested first, then the bits.

* Fingerprints are linked, not documents: copies share one node.
* From a cell come only links that span its linked sets, never all its pairs.
* A cell of more than ``BLOCK`` fingerprints is dealt out in blocks; every pair of
  blocks is a task of its own, so no cell is gathered in one place.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows
each get a row. ``component_id`` ignores null ids; it is null where nothing else is there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import free, prepare, same_key, settle, table, texts, with_findings
from tallyhouse.llm.components import components

SHINGLE, SEED, REACH = 4, 42, 4
SEGMENTS, GROUPS, BLOCK = 32, 8, 2048


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; signed 64 bits."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    width = min(shingle, len(words))
    to = (ends[width - 1:] - 1).tolist()
    start = [0, *ends[:len(words) - width].tolist()]
    hashed = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(start, to)]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashed), 16384):
        bits = np.unpackbits(np.array(hashed[at:at + 16384], dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(votes * 2 > len(hashed))
    return int(packed.view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``h``, ``fp`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t) for t in batch["text"].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["h"], fps], names=["doc_id", "h", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, h long, fp long")


def _masks() -> list[int]:
    """For each choice of 4 of the 8 groups the bits of their segments, as signed numbers."""
    edges = [round(g * SEGMENTS / GROUPS) for g in range(GROUPS + 1)]
    parts = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, GROUPS - REACH)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def spanning(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is linked within ``fps`` (distinct), and no more of them
    than its members. Manhattan distance of byte-wise counts first, then the bits."""
    if len(fps) == 2:
        a, b = int(fps[0]), int(fps[1])
        return [(a, b)] if ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= REACH else []
    counts = np.bitwise_count(fps.view(np.uint8)).reshape(-1, 8).astype(np.int8)
    plain = fps.view(np.uint64)
    left, out = np.arange(len(fps)), []
    while len(left) > 1:
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.abs(counts[left] - counts[at]).sum(axis=1) <= REACH
            near[near] = np.bitwise_count(plain[left[near]] ^ plain[at]) <= REACH
            found = left[near]
            left = left[~near]
            out += [(int(fps[at]), int(fps[i])) for i in found]
            frontier += found.tolist()
    return out


def links(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``u``, ``v``: links of at most 4 bits that connect the same fingerprints as all such
    links do. ``nodes`` has one row per fingerprint ``fp``."""
    odd, even = (F.expr(f"{x} & 6148914691236517205L") for x in ("shiftrightunsigned(fp, 1)", "fp"))
    counts = F.shiftleft(odd.bitwiseAND(even), 1).bitwiseOR(odd.bitwiseXOR(even))   # 0, 1 or 2 in each two bits
    cells = nodes.select("fp", counts.alias("c")).select(
        "fp", F.posexplode(F.array(*[F.col("c").bitwiseAND(F.lit(m)) for m in _masks()])).alias("k", "cell"))
    shared = cells.groupBy("k", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    # Spark takes 70 cells of a fingerprint for the bytes of one, and would send them all to the driver.
    met = cells.hint("merge").join(shared, ["k", "cell"]).withColumn("blocks", F.ceil(F.col("n") / block))
    met = met.withColumn("b", F.expr("pmod(xxhash64(fp), blocks)"))
    met = met.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    groups = met.groupBy("k", "cell", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi")).agg(F.collect_list("fp").alias("fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, out = batch["fps"], []
            flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            ends = ends - ends[0]
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                if b - a > 1:
                    out += spanning(flat[a:b])
            both = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["u", "v"])

    return groups.select("fps").mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``h``, ``fp``, ``root`` (names the component), ``component_id`` of every row."""
    prepare(docs.sparkSession)
    rows = settle(fingerprints(docs))
    nodes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes))
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = settle(named)
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select(F.col("fp").alias("__fp"), "root", "component_id")
    return rows.join(named, F.col("fp") == F.col("__fp")).drop("__fp")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` reduced to one row of each component: the smallest id (null ids last), then
    the smallest hash of the text; of equal rows one. All columns stay."""
    rows = near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("k")
    keepers = rows.groupBy("root").agg(first).select("k.doc_id", "k.h")
    copies = rows.groupBy("doc_id", "h").agg(F.count("*").alias("copies"))
    id_, h, n = free(docs, "__id", "__h", "__copies")
    keepers = settle(with_findings(keepers, copies).select(F.col("doc_id").alias(id_), F.col("h").alias(h), F.col("copies").alias(n)))
    single, repeated = (keepers.filter(c).hint("shuffle_hash") for c in (F.col(n) == 1, F.col(n) > 1))
    out = docs.join(single, same_key(docs, id_, h), "left_semi")
    if repeated.isEmpty():
        return out
    return out.unionByName(docs.join(repeated, same_key(docs, id_, h), "left_semi").dropDuplicates(["doc_id", "text"]))


def op8_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
