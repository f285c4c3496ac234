"""Line dedup with two Bloom filters.

Pass 1 hashes the key of every long line into two filters, *once seen* and *twice seen*;
tasks fill their own and merge: twice = either twice, or both once. Pass 2 asks the twice
filter; only lines it suspects are shuffled, with their text, to be counted exactly and to
choose the document that keeps them. Filters have ``2 ** BITS`` bits (8 MB each) at any
input size: that bounds what is broadcast. Beyond their capacity they suspect more lines,
never fewer, and results stay exact.

A line's key is the line without ASCII blanks at its ends, lower-cased in A-Z. Keys of at
least ``LONG`` code points found in at least ``DOCS`` documents lose all their lines except
in the document of the largest id that holds them.

* A null or empty text is one empty line.
* Documents are told apart by ``doc_id``; a null id counts for no document and keeps no
  repeated line.
* Rows of one id count as one document; all of them keep the line if it is the largest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import BLANKS, free, join_hot, prepare, same_key, settle, table, texts, with_findings

LONG, DOCS = 40, 5
#: Bits of a filter as a power of two; bits set per key; bytes of a piece of a filter.
BITS, PROBES, PIECE = 26, 2, 1 << 18


def key_of(line: bytes) -> bytes:
    """``line`` is lower-cased already."""
    return line.strip(BLANKS.encode())


def long_keys(text: str, least: int = LONG) -> list[tuple[int, bytes]]:
    """Line numbers and keys of the lines that are long enough."""
    out = []
    for n, line in enumerate(text.encode().lower().split(b"\n")):
        if len(line) >= least:
            key = key_of(line)
            if len(key) >= least and (key.isascii() or len(key.decode()) >= least):
                out.append((n, key))
    return out


def probes(keys: list[bytes], bits: int) -> np.ndarray:
    """Bit positions of each key, one row per probe."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
    second = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((h + np.uint64(i) * second) & np.uint64((1 << bits) - 1)).astype(np.int64) for i in range(PROBES)])


class Filters:
    """A once-seen and a twice-seen filter, one byte to a bit while they are filled."""

    def __init__(self, bits: int):
        self.bits, self.once, self.twice = bits, np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)

    def add(self, keys: list[bytes]) -> None:
        """``keys`` of one document, each once."""
        at = probes(keys, self.bits)
        again = self.once[at].all(axis=0)
        self.twice[at[:, again]] = True
        self.once[at[:, ~again]] = True

    def pieces(self) -> Iterator[tuple[int, bytes]]:
        """Non-empty pieces: twice then once, packed and compressed."""
        width = min(PIECE * 8, 1 << self.bits)
        for n in range((1 << self.bits) // width):
            part = slice(n * width, (n + 1) * width)
            if self.once[part].any():
                yield n, zlib.compress(np.packbits(np.concatenate([self.twice[part], self.once[part]])).tobytes(), 1)


def merge(pieces) -> bytes:
    """One piece out of several of the same place."""
    once = twice = None
    for blob in pieces:
        both = np.frombuffer(zlib.decompress(blob), np.uint8)
        t, o = both[:len(both) // 2], both[len(both) // 2:]
        if once is None:
            twice, once = t.copy(), o.copy()
        else:
            twice |= t | (once & o)
            once |= o
    return zlib.compress(np.concatenate([twice, once]).tobytes(), 1)


def twice_seen(docs: DataFrame, bits: int = BITS) -> np.ndarray:
    """The packed twice-seen filter over all long lines of ``docs``."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, n = Filters(bits), 0
        for batch in batches:
            for text in batch["text"].to_pylist():
                keys = list({k for _, k in long_keys(text)})
                if keys:
                    filters.add(keys)
                    n += len(keys)
        found = list(filters.pieces()) if n else []
        salt = xxhash.xxh32_intdigest(str((n, [len(b) for _, b in found])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in found], pa.int32()), pa.array([salt % 64] * len(found), pa.int32()), pa.array([b for _, b in found], pa.binary())],
            names=["piece", "salt", "filter"])

    def join(rows: pa.Table) -> pa.Table:
        return pa.table({"piece": rows["piece"][:1], "salt": rows["salt"][:1], "filter": pa.array([merge(x.as_py() for x in rows["filter"])], pa.binary())})

    kinds = "piece int, salt int, filter binary"
    parts = docs.select("text").mapInArrow(fill, kinds)
    parts = parts.groupBy("piece", "salt").applyInArrow(join, kinds).groupBy("piece").applyInArrow(join, kinds)
    width = min(PIECE * 8, 1 << bits) // 8
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in parts.collect():   # bounded: two filters of 2 ** bits bits
        out[row["piece"] * width:(row["piece"] + 1) * width] = np.frombuffer(zlib.decompress(row["filter"]), np.uint8)[:width]
    return out


def suspects(docs: DataFrame, twice: np.ndarray, bits: int = BITS) -> DataFrame:
    """``doc_id``, ``h``, ``key``, ``lines``: suspected repeats and their line numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(zlib.compress(twice.tobytes(), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, h, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "h", "text"))):
                places: dict[bytes, list[int]] = {}
                for n, key in long_keys(text):
                    places.setdefault(key, []).append(n)
                if not places:
                    continue
                keys = list(places)
                at = probes(keys, bits)
                hit = ((bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
                rows += [(doc_id, h, keys[i], places[keys[i]]) for i in np.flatnonzero(hit)]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "h", "key", "lines"])

    return docs.mapInArrow(run, "doc_id long, h long, key binary, lines array<int>")


def dropped_lines(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``doc_id``, ``h``, ``drops``: line numbers (from 0) that go; only rows that lose some.

    ``docs`` comes from ``texts``."""
    found = settle(suspects(docs, twice_seen(docs, bits), bits).dropDuplicates(["doc_id", "h", "key"]))
    repeated = found.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"), F.count("*").alias("rows"))
    repeated = settle(repeated.filter(F.col("n") >= DOCS))
    gone = join_hot(found, repeated, "key", "rows", ["doc_id", "h"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc_id", "h").agg(F.flatten(F.collect_list("lines")).alias("drops"))


def without(text: str, drops: list[int]) -> str:
    gone = set(drops)
    return "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)


def deduplicated_lines(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``doc_id``, ``h``, ``n_lines``, ``n_dropped`` and ``kept``, the text that is left."""
    prepare(docs.sparkSession)
    plain = texts(docs)
    joined = with_findings(plain, dropped_lines(plain, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, before, after = [], [], []
            for text, drops in zip(batch["text"].to_pylist(), batch["drops"].to_pylist()):
                before.append(text.count("\n") + 1)
                after.append(len(drops or ()))
                out.append(without(text, drops) if drops else text)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["h"], pa.array(before, pa.int64()), pa.array(after, pa.int64()), pa.array(out, pa.string())],
                names=["doc_id", "h", "n_lines", "n_dropped", "kept"])

    return joined.mapInArrow(run, "doc_id long, h long, n_lines long, n_dropped long, kept string")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines dropped from ``text``; ``n_chars``, if there, follows. Texts
    that lose nothing stay as they are, null ones too."""
    prepare(docs.sparkSession)
    id_, h, mark = free(docs, "__id", "__h", "__drops")
    drops = dropped_lines(texts(docs)).withColumnsRenamed({"doc_id": id_, "h": h, "drops": mark})
    joined = docs.join(drops.hint("shuffle_hash"), same_key(docs, id_, h), "left").drop(id_, h)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drops = batch[mark].to_pylist()
            columns = {n: batch[n] for n in batch.schema.names if n != mark}
            cut = [text if not gone else without(text, gone) for text, gone in zip(batch["text"].to_pylist(), drops)]
            columns["text"] = pa.array(cut, pa.string())
            if "n_chars" in columns:
                sizes = [n if not gone else len(t) for n, t, gone in zip(columns["n_chars"].to_pylist(), cut, drops)]
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return joined.mapInArrow(run, schema)


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = deduplicated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = """
with lines as (
  select doc_id, n, line, lower_key, length(lower_key) >= 40 as long from (
    select doc_id, n, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_key
    from (select doc_id, unnest(s) as line, generate_subscripts(s, 1) as n from (select doc_id, string_split(coalesce(text, ''), chr(10)) as s from documents))
  )
), repeated as (
  select lower_key, max(doc_id) as keeper from lines where long group by 1 having count(distinct doc_id) >= 5
), marked as (
  select l.doc_id, n, line, coalesce(l.doc_id <> r.keeper, false) as gone
  from lines l left join repeated r on l.long and l.lower_key = r.lower_key
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by n) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""
