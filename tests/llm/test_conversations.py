"""Conversation repair against the plain dynamic programme."""

import random

import pytest

from tallyhouse.llm import conversations
from tallyhouse.llm.queries import QUERIES
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string, present string, kind int, digest string"
FIELDS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def _rows():
    rng = random.Random(11)
    said = ["Yes.", "No!", "Why?", "cut", "", " \t\n", "Once more.", "end é", "A longer answer.\n  ", None, ".", "so: \U0001F600"]
    rows = []
    for conv in range(400):
        turn = 0
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 9, 14])):
            turn += rng.choice([0, 1, 1, 1, 1, 1, 3])
            rows.append((conv, rng.choice([turn] * 12 + [None]), rng.choice(["user"] * 6 + ["assistant"] * 6 + ["system", "tool", "", "sys", "User", None]), rng.choice(said)))
    rows += [(None, t, "user", "Hello.") for t in range(4)] + [(None, None, None, None)] * 3
    rows += [(1000, t, "user" if t % 2 else "assistant", f"Say {t}.") for t in range(3000)]        # one long conversation
    rows += [(1001, 7, "user", "again.")] * 500 + [(1002, -2**40, "user", "far."), (1002, 2**40, "assistant", "away.")]
    rows += [(1003, t, "user", f"only {t}.") for t in range(700)]
    return rows


@pytest.fixture(scope="module")
def talks(spark, tmp_path_factory):
    rows, folder = _rows(), str(tmp_path_factory.mktemp("talks"))
    spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA).repartition(7).write.parquet(f"{folder}/conversations.parquet")
    return folder, rows


def test_repair(spark, talks):
    got = ordered(tuple(r) for r in QUERIES["op13_conversation_repair"](spark, talks[0]).select(*FIELDS).collect())
    assert got == ordered(brute.op13(talks[1]))
    assert len(got) > 300 and {"K", "D", "I", "R"} <= set("".join(r[7] for r in got))


def test_parts_of_a_conversation_meet(spark, talks):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # so that ranges stay apart
    try:
        rows = conversations.damaged(spark.read.parquet(f"{talks[0]}/conversations.parquet"))
        parts = conversations.segments(conversations.symbols(conversations.prepared(rows)))
        assert parts.filter("conv_id = 1000").count() > 1
        got = ordered(tuple(r)[:8] for r in conversations.reports(rows).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == ordered(r[:8] for r in brute.op13(talks[1]))


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "What"), (1, 1, "user", "What"), (2, 0, "system", "Be kind."), (3, 5, "user", "")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    report = conversations.reports(df)
    told = {r["conv_id"]: r for r in report.collect()}
    assert [(told[c]["cost"], told[c]["audit"]) for c in "123"] == [(c, a) for _, _, _, _, _, _, c, a, _ in sorted(brute.op13([(str(r[0]), *r[1:]) for r in rows], damage=False))]
    left = [tuple(r) for r in conversations.repaired(df, report).orderBy("conv_id", "place").collect()]
    roles = {c: "".join(r[2][0] for r in left if r[0] == c) for c in "123"}
    assert all(brute.re.fullmatch("(s?(ua)+)?", x) for x in roles.values())
    assert [r[1] for r in left if r[0] == "1"] == list(range(len(roles["1"])))


def test_long_runs_equal_short_steps():
    rng, repair = random.Random(5), conversations.Repair()
    for _ in range(300):
        runs = [(rng.choice("suaoSUAOx"), rng.choice([1, 1, 1, 2, 3, 8])) for _ in range(rng.randint(0, 8))]
        plain = [(s.lower(), s == "x", s.isupper()) for s, n in runs for _ in range(n)]
        text = conversations.squeezed([list(r) for r in runs])
        assert repair(text) == brute.cheapest(plain) and len(text) <= max(1, len(plain))
    for symbol in "uax":
        cost, audit = repair(f"{symbol}5000")
        assert (cost, audit) == brute.cheapest([(symbol, symbol == "x", False)] * 5000)
    assert len(repair.powers["u"]) <= 14
