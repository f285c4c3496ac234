from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import clean, keys
from tallyhouse.functions.money import convert, percent, ratio


def one(spark, column, **values):
    types = {str: "string", int: "bigint"}
    df = spark.range(1).select(
        *[F.lit(v).cast(types[type(v)] if v is not None else "string").alias(k) for k, v in values.items()]
    )
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "text, want",
    [
        (None, None), ("free", None), ("+-", None), ("7-7", None), ("1.1.1", None), ("( )", None), ("..", None), ("NAN", None), ("\t", None),
        ("0", "0"), ("kr 17", "17"), ("¥1,000,001", "1000001"), ("(2)", "-2"), ("( -2.50 )", "-2.5"), ("-0.001€", "-0.001"), (".25", "0.25"), ("6.", "6"),
        ("$9,876,543,210,987,654.321", "9876543210987654.321"), ("0.0000000049", "0.0000000049"),
    ],
)
def test_parse_money(spark, text, want):
    got = one(spark, clean.parse_money("t"), t=text)
    assert got == (None if want is None else Decimal(want))


def test_money_that_fits_nowhere_fails(spark):
    with pytest.raises(Exception):
        one(spark, clean.parse_money("t"), t="1" * 30)


@pytest.mark.parametrize("text, want", [("0.5%", "0.005"), ("n/a", None), ("-250 %", "-2.5"), ("(3%)", "-0.03")])
def test_parse_percent(spark, text, want):
    got = one(spark, clean.parse_percent("t"), t=text)
    assert got == (None if want is None else Decimal(want))


@pytest.mark.parametrize(
    "text, want",
    [
        ("x", None), ("31.50", None), ("31.00", 31), ("31.", 31), ("\t31\n", 31), ("9,031", 9031), ("31/2", None), ("A31", None), ("3 1", None),
        (None, None), ("", None), ("0", 0), ("-31", None), ("9" * 22, None),
    ],
)
def test_parse_order_code(spark, text, want):
    assert one(spark, clean.parse_order_code("t"), t=text) == want


@pytest.mark.parametrize(
    "text, want", [("2/29/2020", date(2020, 2, 29)), ("2/29/2021", None), ("31/12/2020", None), (" 12/01/1999 ", date(1999, 12, 1)), (None, None), ("2020-02-29", None)])
def test_parse_order_date(spark, text, want):
    assert one(spark, clean.parse_order_date("t"), t=text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("1999-12-31T23:00:00-03:30", datetime(2000, 1, 1, 2, 30)), ("2004-02-29T00:00:00Z", datetime(2004, 2, 29)),
        (" \t", None), ("2004-02-29T06:07:08", datetime(2004, 2, 29, 6, 7, 8)), (None, None), ("", None),
    ],
)
def test_parse_gmt(spark, text, want):
    got = one(spark, F.date_format(clean.parse_gmt("t"), "yyyy-MM-dd HH:mm:ss"), t=text)
    assert got == (None if want is None else want.strftime("%Y-%m-%d %H:%M:%S"))


def test_bad_numbers_and_times_fail(spark):
    with pytest.raises(Exception):
        one(spark, clean.safe_decimal("t"), t="abc")
    with pytest.raises(Exception):
        one(spark, clean.parse_gmt("t"), t="yesterday")


@pytest.mark.parametrize(
    "build, text, want",
    [
        (clean.first_segment, "40 cm|blue", "40 cm"), (clean.first_segment, "|blue", None), (clean.first_segment, None, None),
        (clean.strip_surcharge, "Sleeve (€1)(€2) ", "Sleeve"), (clean.strip_surcharge, "Hood (+€0) | 3", "Hood"),
        (clean.strip_surcharge, "Cuff (left) only", "Cuff (left) only"), (clean.norm_code, " gb ", "GB"), (clean.norm_code, "  ", None),
        (clean.clean_cell, " x ", "x"), (clean.clean_cell, "\t ", None), (clean.clean_cell, "NAN", None), (clean.clean_cell, "nanny", "nanny"),
    ],
)
def test_labels(spark, build, text, want):
    assert one(spark, build("t"), t=text) == want


def test_headers(rows):
    df = rows([("1", "2", "3", "4")], ["Ñáme tag", "Phone", " Férry ", "Náme"])
    assert clean.drop_pii(clean.fold_headers(df)).columns == ["Name tag", "Ferry"]


def test_quantity_clamp(spark):
    assert [one(spark, clean.clamp_quantity("t"), t=t) for t in ("3", "-2", None)] == [3, 0, 0]


def test_keys(spark):
    import hashlib

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    assert one(spark, keys.sk("a", "b"), a="S1", b=7) == md5("S1-7")
    assert one(spark, keys.sk("a", "b"), a="S1", b=None) == md5("S1-_dbt_utils_surrogate_key_null_")
    assert one(spark, keys.hash_pii("e", "salt"), e=" Ann@X.com ") == hashlib.sha256(b"ann@x.comsalt").hexdigest()
    assert one(spark, keys.hash_pii("e", "salt"), e="  ") is None
    assert one(spark, keys.customer_hash("h", "s", "k"), h=None, s="S1", k=5) == "unknown:S1:5"
    assert one(spark, keys.date_sk(F.lit("2024-02-09").cast("date"))) == 20240209
    assert one(spark, keys.date_of_sk(F.lit(20240209))) == date(2024, 2, 9)


def test_salt_is_hidden_in_plans(spark):
    from tallyhouse.session import pii_salt

    salt = pii_salt(spark, "very-secret-salt")
    df = spark.range(1).select(keys.hash_pii(F.col("id").cast("string"), salt))
    shown = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "very-secret-salt" not in shown


def test_ratios(spark):
    assert one(spark, ratio(F.lit("1"), F.lit("3"))) == Decimal("0.333333")
    assert one(spark, ratio(F.lit("1"), F.lit("0"))) is None
    assert one(spark, percent(F.lit(1), F.lit(32))) == Decimal("3.13")
    assert one(spark, convert(F.lit("-0.5"), F.lit("0.000001"))) == Decimal("-0.000001")
