"""Surrogate keys, date keys and hashed identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.money import col

# Key text must equal the keys already stored downstream.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
NO_COUNTRY = "XX"
NO_METHOD = "unknown"


def sk(*parts: Column | str) -> Column:
    """md5 text key of one or more columns, NULL-safe."""
    texts = [F.coalesce(col(p).cast("string"), F.lit(NULL_KEY_TEXT)) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


def date_sk(day: Column | str) -> Column:
    d = col(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_of_sk(key: Column | str) -> Column:
    k = col(key)
    return F.make_date((k / 10000).cast("int"), ((k / 100) % 100).cast("int"), (k % 100).cast("int"))


def hash_pii(email: Column | str, salt: str) -> Column:
    """Salted SHA-256 of a normalised e-mail; blank is NULL."""
    text = F.trim(col(email))
    return F.when(text != "", F.sha2(F.concat(F.lower(text), F.lit(salt)), 256))


def customer_hash(hashed: Column | str, site: Column | str, order_id: Column | str) -> Column:
    """The e-mail hash, or a key of its own for an order without e-mail."""
    own = F.concat(F.lit("unknown:"), col(site), F.lit(":"), col(order_id).cast("string"))
    return F.coalesce(col(hashed), own)


def country_or_none(code: Column | str) -> Column:
    return F.coalesce(col(code), F.lit(NO_COUNTRY))


def method_or_none(method: Column | str) -> Column:
    return F.coalesce(F.nullif(F.trim(col(method)), F.lit("")), F.lit(NO_METHOD))
