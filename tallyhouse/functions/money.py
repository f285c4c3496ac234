"""Decimal types and arithmetic for money, rates and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,6)"     # one line, fee or rate-converted amount; fits a long
TOTAL = "decimal(28,6)"     # a sum: one order or customer may hold a third of all lines
RATE = "decimal(18,10)"     # exchange rate
RATIO = "decimal(28,6)"     # published ratio


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return col(c).cast(MONEY)


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0).cast(MONEY))


def convert(amount: Column | str, rate: Column | str) -> Column:
    """Amount times rate, rounded half away from zero to six places."""
    return F.round(money(amount) * col(rate).cast(RATE), 6).cast(MONEY)


def _quotient(a: Column | str, b: Column | str, kind: str) -> Column:
    den = F.nullif(col(b).cast(TOTAL), F.lit(0).cast(TOTAL))
    return F.round(col(a).cast(kind) / den, 6).cast(RATIO)


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` of two order amounts to six places; NULL when ``b`` is zero or NULL.

    Spark cuts the scale of a decimal quotient to what 38 digits leave beside the
    whole digits of the numerator, so the numerator stays as narrow as its kind
    allows: 18 whole digits here leave 14 decimals before rounding.
    """
    return _quotient(a, b, "decimal(24,6)")


def total_ratio(a: Column | str, b: Column | str) -> Column:
    """The same for sums over everything: 20 whole digits, 12 decimals."""
    return _quotient(a, b, "decimal(26,6)")


def percent(a: Column | str, b: Column | str) -> Column:
    """``100 a / b`` to two places over counts; NULL when ``b`` is zero or NULL."""
    num = (col(a) * 100).cast("decimal(20,0)")
    den = F.nullif(col(b), F.lit(0)).cast("decimal(20,0)")
    return F.round(num.cast("decimal(20,6)") / den, 2).cast("decimal(28,2)")


def sum_money(c: Column | str) -> Column:
    return F.sum(money(c)).cast(TOTAL)
