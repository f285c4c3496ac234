"""Conversation structure repair by a run-length, min-plus dynamic programme.

A conversation is to read ``(system?) (user assistant)+`` or be empty. Every row is
reduced to one symbol: its role initial (s, u, a, o for others), a capital if its text is
cut off, or x if it must go (blank, or role and text seen earlier). Equal consecutive
symbols are collapsed into runs. A symbol is a min-plus matrix over the four states a
prefix may be in; a run is passed through cached binary powers of its matrix, backwards.
The cheapest edits are then unrolled forwards: of equally cheap ones the least letter.

How it runs:

1. Equal rows of a conversation are counted, so rows are told apart by turn, role and a
   digest of both role and text. Repeats over several turns are found by an aggregate.
2. These rows, without texts, are dealt by range over conversation, turn, role and digest:
   a conversation of very many rows lies in many tasks. Each task hands on the runs of a
   conversation's rows it has, and their counts.
3. The runs of a conversation meet in one row. They are never longer than its audit, which
   is one cell of the result.
4. Texts are ordered behind their conversation's audit and streamed once. A digest of a
   whole conversation is made in one task, row by row, since it can't be made in parts.

* Null roles and texts count as one space, null turns come before all others, and a null
  conversation id is a conversation of its own. An empty role has no initial.
* Rows of one turn are taken by role, then by digest; equal rows stand next to each other.
* A conversation without any row present is reported with zeros and an empty audit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import prepare, settle, table

# What edits cost.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: Rows of a run whose costs are held at once while choices are unrolled.
CHUNK = 1024
#: Conversations a task remembers the repair of.
REMEMBERED = 50_000

#: States of a prefix: nothing yet, after s, after u, after a. It may end in the first and the last.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_INSERTED = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
NEVER = 1 << 50


def _edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of what may be done with a row, in order of the letters."""
    out = [("D", DELETE, state)]
    if symbol != "x":
        extra = CUT_OFF if symbol.isupper() else 0
        due = _INSERTED[state]
        if symbol.lower() == "s" and state == START:
            out.append(("K", extra, AFTER_S))
        elif symbol.lower() == "ua"[due == AFTER_A]:
            out.append(("K", extra, due))
        out.append(("R", REROLE + extra, due))
    return out


def _times(a: list, b: list) -> list:
    return [[min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)] for row in a]


def _ahead(m: list, after: tuple) -> tuple:
    return tuple(min(x + y for x, y in zip(row, after)) for row in m)


class Repair:
    """Cheapest edits; keeps the powers of each symbol's matrix and the choices it has met."""

    def __init__(self):
        hop = [[NEVER] * 4 for _ in range(4)]
        for state in range(4):
            hop[state][state] = 0
        for state in range(4):
            hop[state][_INSERTED[state]] = INSERT
        self.inserts = _times(_times(hop, hop), hop)       # any number of inserts that may pay
        self.powers: dict[str, list] = {}
        self.choices: dict[tuple, tuple[str, int]] = {}
        self.known: dict[str, tuple[int, str]] = {}

    def power(self, symbol: str, k: int) -> list:
        """The matrix of ``2**k`` rows of a symbol."""
        known = self.powers.get(symbol)
        if known is None:
            step = [[NEVER] * 4 for _ in range(4)]
            for state in range(4):
                for _, cost, to in _edits(symbol, state):
                    step[state][to] = min(step[state][to], cost)
            known = self.powers[symbol] = [_times(self.inserts, step)]
        while len(known) <= k:
            known.append(_times(known[-1], known[-1]))
        return known[k]

    def before(self, symbol: str, n: int, after: tuple) -> tuple:
        """Least costs before ``n`` rows of a symbol, from those after them."""
        k = 0
        while n:
            if n & 1:
                after = _ahead(self.power(symbol, k), after)
            n >>= 1
            k += 1
        return after

    def choice(self, symbol: str, state: int, after: tuple) -> tuple[str, int]:
        """The letters up to a row's own one, and the state they lead to."""
        least = min(after)
        key = (symbol, state, *(x - least for x in after))
        found = self.choices.get(key)
        if found is None:
            letters, at = "", state
            while True:
                best = self.before(symbol, 1, after)[at]
                due = [(x, to) for x, cost, to in _edits(symbol, at) if cost + after[to] == best]
                inserting = INSERT + self.before(symbol, 1, after)[_INSERTED[at]] == best
                if due and not (inserting and due[0][0] > "I"):
                    found = letters + due[0][0], due[0][1]
                    break
                letters, at = letters + "I", _INSERTED[at]
            self.choices[key] = found
        return found

    def __call__(self, runs: str) -> tuple[int, str]:
        """Cost and audit of a conversation given by its runs (as ``squeezed`` writes them)."""
        found = self.known.get(runs)
        if found is None:
            found = self.solve(unsqueezed(runs))
            if len(runs) <= 64:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[runs] = found
        return found

    def solve(self, runs: list[tuple[str, int]]) -> tuple[int, str]:
        end = tuple(row[START] if state == START else min(row[START], row[AFTER_A]) for state, row in enumerate(self.inserts))
        costs = [end]
        for symbol, n in reversed(runs):
            costs.append(self.before(symbol, n, costs[-1]))
        costs.reverse()
        letters, state = [], START
        for (symbol, n), after in zip(runs, costs[1:]):
            while n:
                part = min(n, CHUNK)
                held = [self.before(symbol, n - part, after)]
                for _ in range(part - 1):
                    held.append(self.before(symbol, 1, held[-1]))
                for behind in reversed(held):
                    got, state = self.choice(symbol, state, behind)
                    letters.append(got)
                n -= part
        while state in (AFTER_S, AFTER_U):
            letters.append("I")
            state = _INSERTED[state]
        return costs[0][START], "".join(letters)


def squeezed(runs: list[list]) -> str:
    """Runs as text: ``u``, ``a``, ``x3``: at most one character a row."""
    return "".join(s + (str(n) if n > 2 else s * (n - 1)) for s, n in runs)


def unsqueezed(text: str) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = []
    for symbol, n in re.findall(r"([A-Za-z])(\d*)", text):
        n = int(n or 1)
        if out and out[-1][0] == symbol:
            n += out.pop()[1]
        out.append((symbol, n))
    return out


def prepared(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and ``present`` (true, unless a boolean column
    of that name says otherwise); null roles and texts are one space."""
    present = F.coalesce("present", F.lit(False)) if ("present", "boolean") in rows.dtypes else F.lit(True)
    plain = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *plain, present.alias("present"))


def _digest():
    return F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)


def symbols(rows: DataFrame) -> DataFrame:
    """One row for each set of equal rows: ``conv_id``, ``turn``, ``role``, ``digest``, ``n``,
    ``initial``, ``blank``, ``cut_off`` and ``again`` (role and text stand in an earlier turn)."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*+\z", 1)
    initial = F.substring("role", 1, 1)
    marked = rows.select(
        "conv_id", "turn", "role", "present", _digest().alias("digest"), F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut_off"))
    counted = settle(marked.groupBy(*marked.columns).agg(F.count("*").alias("n")))
    # Repeats in other turns: the first turn of a text, null before all others.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    several = counted.filter("present and not blank").groupBy("conv_id", "digest").agg(F.min(place).alias("first"), F.count("*").alias("turns"))
    several = several.filter("turns > 1").select(F.col("conv_id").alias("__conv"), F.col("digest").alias("__digest"), "first")
    on = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("digest") == F.col("__digest"))
    again = F.coalesce(place > F.col("first"), F.lit(False))
    return counted.join(several, on, "left").select(*counted.columns, again.alias("again"))


_PART = "part int, runs string, first string, last string, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long"
_LEGAL = ("su", "ua", "au")


class _Segment:
    """The rows of a conversation in one task, in order."""

    def __init__(self, conv_id):
        self.conv_id, self.runs, self.first, self.last = conv_id, [], "", ""
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None

    def put(self, symbol: str, n: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += n
        elif n:
            self.runs.append([symbol, n])

    def add(self, turn, initial: str, n: int, blank: bool, cut_off: bool, again: bool) -> None:
        if self.last:
            self.illegal += self.last + initial not in _LEGAL
        self.illegal += n - 1                        # no role may follow itself
        self.first, self.last = self.first or initial, initial
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.turns += 1
        if blank:
            self.blank += n
            self.put("x", n)
            return
        more = n if again else n - 1
        self.duplicate += more
        if not again:
            self.truncated += cut_off
            self.put(initial.upper() if cut_off else initial, 1)
        self.put("x", more)

    def row(self, part: int) -> tuple:
        return (self.conv_id, part, squeezed(self.runs), self.first, self.last, self.blank, self.duplicate, self.truncated, self.illegal, self.low, self.high, self.turns)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def segments(found: DataFrame) -> DataFrame:
    """Runs and counts of each conversation by task, in ranges of conversation, turn, role and digest."""
    order = ["conv_id", "turn", "role", "digest"]                 # nulls come first
    dealt = settle(found).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([found.schema["conv_id"], *T._parse_datatype_string(_PART).fields])
    fields = ("conv_id", "turn", "initial", "n", "blank", "cut_off", "again", "present")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, own, out = TaskContext.get().partitionId(), _arrow(schema), None, []
        for batch in batches:
            for conv, turn, initial, n, blank, cut_off, again, present in zip(*(batch[c].to_pylist() for c in fields)):
                if own is None or own.conv_id != conv:
                    if own:
                        out.append(own.row(part))
                    own = _Segment(conv)
                if present:
                    own.add(turn, initial, n, blank, cut_off, again)
            if len(out) > 10_000:
                yield _table(out, names)
                out = []
        if own:
            out.append(own.row(part))
        if out:
            yield _table(out, names)

    return dealt.select(*fields).mapInArrow(build, schema)


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def reports(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id``: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost`` and ``audit`` (an edit's letter for each row and insert)."""
    prepare(rows.sparkSession)
    parts = segments(symbols(prepared(rows)))
    names = [f.name for f in T._parse_datatype_string(_PART).fields]
    met = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("parts"))
    schema = T.StructType([rows.schema["conv_id"], *T._parse_datatype_string(REPORT).fields])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, names = Repair(), _arrow(schema)
        for batch in batches:
            out = []
            for conv, own in zip(batch["conv_id"].to_pylist(), batch["parts"].to_pylist()):
                sums = [sum(p[c] for p in own) for c in ("blank", "duplicate", "truncated", "illegal")]
                held = [p for p in own if p["first"]]
                sums[3] += sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(held, held[1:]))
                dated = [p for p in held if p["turns"]]
                turns = sum(p["turns"] for p in dated) - sum(a["high"] == b["low"] for a, b in zip(dated, dated[1:]))
                gaps = dated[-1]["high"] - dated[0]["low"] + 1 - turns if dated else 0
                out.append((conv, gaps, *sums, *repair("".join(p["runs"] for p in held))))
            if out:
                yield _table(out, names)

    return met.mapInArrow(solve, schema)


def _followed(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Rows behind the report of their conversation, in order: ``follow`` reads this."""
    own = prepared(rows).filter("present").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", _digest().alias("digest"))
    told = report.withColumn("kind", F.lit(0))
    both = told.unionByName(own, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")


def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Carries out the edits: ``("row", conv_id, role, text)`` for every row that is left,
    and ``("end", report, None, None)`` behind each conversation."""
    report, letters, last = None, iter(()), ""

    def inserted() -> tuple:
        nonlocal last
        last = "a" if last == "u" else "u"
        return "row", report["conv_id"], "assistant" if last == "a" else "user", ""

    def rest() -> Iterator[tuple]:
        if report is not None:
            for _ in letters:
                yield inserted()
            yield "end", report, None, None

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                yield from rest()
                report, letters, last = row, iter(row["audit"]), ""
                continue
            for letter in letters:
                if letter == "I":
                    yield inserted()
                    continue
                if letter == "K":
                    last = row["role"][:1]
                    yield "row", row["conv_id"], row["role"], row["text"]
                elif letter == "R":
                    _, conv, role, _ = inserted()
                    yield "row", conv, role, row["text"]
                break
    yield from rest()


def repaired(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 0), ``role``, ``text``."""
    schema = T.StructType([rows.schema["conv_id"], *T._parse_datatype_string("place long, role string, text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, out, place = _arrow(schema), [], 0
        for kind, conv, role, text in follow(batches):
            if kind == "end":
                place = 0
                continue
            out.append((conv, place, role, text))
            place += 1
            if len(out) >= 1000:
                yield _table(out, names)
                out = []
        if out:
            yield _table(out, names)

    return _followed(rows, report).mapInArrow(run, schema)


def with_digest(rows: DataFrame, report: DataFrame) -> DataFrame:
    """``report`` with ``repaired_sha256`` over ``role:text`` of the repaired rows, a line each."""
    schema = T.StructType([*report.schema.fields, T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, out, sha, lead = _arrow(schema), [], hashlib.sha256(), ""
        for kind, what, role, text in follow(batches):
            if kind == "row":
                sha.update(f"{lead}{role}:{text}".encode())
                lead = "\n"
                continue
            out.append((*(what[f] for f in report_fields), sha.hexdigest()))
            sha, lead = hashlib.sha256(), ""
            if len(out) >= 1000:
                yield _table(out, names)
                out = []
        if out:
            yield _table(out, names)

    report_fields = report.columns
    return _followed(rows, report).mapInArrow(run, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the damage of the exercise; dropped ones stay with ``present`` false."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    out = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"))
    return out.drop("copy")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return with_digest(rows, reports(rows))
