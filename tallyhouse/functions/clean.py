"""Cleaning of text cells, order codes, dates, JSON fields and variant labels."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import MONEY, col

#: Amounts in cells: wide enough for what a sheet can hold, and exact.
CELL = "decimal(38,10)"

# Every character Python's ``str.strip`` removes, so a cell trims alike here.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# Personal-data headers, dropped before anything is written.
PII_HEADERS = ("Name", "Email", "Phone", "Ship to")


def fold_header(name: str) -> str:
    """Header text without diacritics or outer blanks."""
    plain = unicodedata.normalize("NFKD", name)
    return "".join(ch for ch in plain if not unicodedata.combining(ch)).strip()


def fold_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[fold_header(c) for c in df.columns])


def drop_pii(df: DataFrame, headers: tuple[str, ...] = PII_HEADERS) -> DataFrame:
    return df.drop(*[h for h in headers if h in df.columns])


def strip(c: Column | str) -> Column:
    return F.trim(col(c), F.lit(WHITESPACE))


def clean_cell(c: Column | str) -> Column:
    """Trimmed text; blank and ``nan`` become NULL."""
    return F.when(~col(c).rlike(f"(?i)^[{WHITESPACE}]*(nan)?[{WHITESPACE}]*$"), strip(c))


def parse_money(c: Column | str) -> Column:
    """Amount in a cell whatever the currency sign; ``(x)`` is negative; junk is NULL.

    Only text that is no number gives NULL; a number beyond ``CELL`` fails the job.
    Blank and ``nan`` hold no digit, so they need no test of their own. Each cell
    text is named as few times as can be: a sheet has a dozen such columns, and
    generated code grows with every mention.
    """
    plain = F.regexp_replace(col(c), r"[^0-9.\-]", "")
    number = F.nullif(F.regexp_extract(plain, r"^-?(\d+\.?\d*|\.\d+)$", 0), F.lit("")).cast(CELL)
    bracketed = strip(c).rlike(r"(?s)^\(.*\)$")
    return F.when(bracketed, -F.abs(number)).otherwise(number).cast(CELL)


def parse_percent(c: Column | str) -> Column:
    return (parse_money(c) / F.lit(100)).cast(CELL)


def parse_order_code(c: Column | str) -> Column:
    """Plain integer order id; suffixed or fractional codes are NULL, and so is a number
    no id can be (``off_platform_codes`` lists all of these)."""
    text = F.replace(strip(c), F.lit(","), F.lit(""))
    return F.regexp_extract(text, r"^(\d+)(\.0*)?$", 1).try_cast("bigint")


def parse_order_date(c: Column | str) -> Column:
    """US month/day/year; anything else is NULL."""
    return F.try_to_timestamp(strip(c), F.lit("M/d/yyyy")).cast("date")


def parse_gmt(c: Column | str) -> Column:
    """ISO timestamp, UTC unless it carries an offset; blank is NULL, junk fails."""
    return F.nullif(strip(c), F.lit("")).cast("timestamp")


def json_text(payload: Column | str, path: str) -> Column:
    """Text at a JSON path such as ``billing.country``; missing and null are NULL."""
    return F.get_json_object(col(payload), "$." + path)


def safe_decimal(c: Column | str, kind: str = MONEY) -> Column:
    """Blank is NULL, bad text fails."""
    return F.nullif(col(c), F.lit("")).cast(kind)


def norm_code(c: Column | str) -> Column:
    return F.nullif(F.trim(F.upper(col(c))), F.lit(""))


def first_segment(c: Column | str) -> Column:
    """First ``|`` segment of a packed attribute."""
    return F.nullif(F.trim(F.substring_index(col(c), "|", 1)), F.lit(""))


def strip_surcharge(c: Column | str) -> Column:
    """First segment without trailing ``(...)`` price notes."""
    label = F.substring_index(col(c), "|", 1)
    noted = F.contains(label, F.lit(")"))       # most labels have no note, and need no pattern
    bare = F.when(noted, F.regexp_replace(label, r"(\s*\([^)]*\))+\s*$", "")).otherwise(label)
    return F.nullif(F.trim(bare), F.lit(""))


def clamp_quantity(c: Column | str) -> Column:
    return F.greatest(F.coalesce(col(c).cast("int"), F.lit(0)), F.lit(0))


def refund_magnitude(c: Column | str) -> Column:
    return F.abs(safe_decimal(c)).cast(MONEY)


def month_start(c: Column | str) -> Column:
    return F.trunc(col(c), "MM")


# Order states that void an order, and those that bear revenue.
VOID_STATES = ("cancelled", "failed")
REVENUE_STATES = ("completed", "processing", "refunded")


def is_void(status: Column | str) -> Column:
    return col(status).isin(*VOID_STATES)


def bears_revenue(status: Column | str) -> Column:
    return col(status).isin(*REVENUE_STATES)


def tier(c: Column, bounds: list, labels: list[str], otherwise: str, descending: bool = True) -> Column:
    """Label of the first bound met; NULL falls through to ``otherwise``."""
    chain = None
    for bound, label in zip(bounds, labels):
        met = (c >= bound) if descending else (c < bound)
        chain = F.when(met, label) if chain is None else chain.when(met, label)
    return chain.otherwise(otherwise)
