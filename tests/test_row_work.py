"""Rows are hashed, priced and looked up once, not for every pass over them."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.clean import strip_surcharge
from tallyhouse.plans import warehouse
from tallyhouse.plans.staging import pivot_meta
from tallyhouse.queries.adapter import with_line_id


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_are_told_apart_before_texts_are_hashed(run):
    shown = plan(with_line_id(run.table("lineitem")))
    anti, semi = shown.split("Exchange hashpartitioning")
    assert "md5" in anti.split("LeftAnti")[0] and "md5" not in anti.split("LeftAnti")[1]
    assert "md5" in semi.split("LeftSemi")[0] and "md5" not in semi.split("LeftSemi")[1]


def test_ranges_are_sampled_before_orders_are_priced(star, spark, monkeypatch):
    written, orders, facts = [], star.stg_orders, star.fact_order

    def keep(df, path, *rest):
        written.append(df)
        return write(df, path, *rest)

    write = warehouse._write
    monkeypatch.setattr(warehouse, "_write", keep)
    again = warehouse.Star(star.inputs, spark, f"{star.path}/priced")
    again.written |= {"stg_orders": orders}
    assert sorted(map(str, again.fact_order.collect())) == sorted(map(str, facts.collect()))
    below = plan(written[0]).split("rangepartitioning")[1]
    assert "Join" not in below and "fx_rate" not in below


META = [
    None,
    [],
    [("k", "b"), ("x", "z")],
    [("k", "b"), ("x", "z"), ("k", "c"), ("k", None)],
    [("k", None)],
    [(None, "q"), ("k", "b")],
    [(None, "q"), (None, "r"), ("k", "b")],
    [None, ("k", "b")],
    [None, None, ("k", "b"), ("k", "a")],
    [("x", "z"), ("x", "y")],
]


def test_pivot_takes_the_highest_value_of_a_key(rows):
    df = rows([(i, m) for i, m in enumerate(META)], "i int, meta array<struct<key: string, value: string>>")
    found = {r.i: r.v for r in df.select("i", pivot_meta(F.col("meta"), "key", "k").alias("v")).collect()}
    values = [[v for e in m or [] if e is not None for k, v in [e] if k == "k" and v is not None] for m in META]
    assert found == {i: max(v, default=None) for i, v in enumerate(values)}
    assert "array_position" in plan(df.select(pivot_meta(F.col("meta"), "key", "k")))


@pytest.mark.parametrize("text, label", [
    ("Front", "Front"), ("Back ($0.00)", "Back"), ("Back ($0.00)|x (y)", "Back"), ("a) b", "a) b"), ("(x)", None),
    ("|x", None), ("", None), (None, None), ("a (b) c (d)", "a (b) c"),
])
def test_labels_lose_their_notes(rows, text, label):
    df = rows([(text,)], "t string").select(strip_surcharge("t").alias("v"))
    assert df.first().v == label
