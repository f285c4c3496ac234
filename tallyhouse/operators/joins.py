"""Join helpers: dated exchange rates, key sets, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import RATE, convert

def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out to all cores where a scan has fewer splits than cores.

    For costly row work (parsing documents) over a small input, which would else
    run on one core. A large input has splits enough and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def rates_by_currency(quotes: DataFrame, until: Column) -> DataFrame:
    """A row per currency with its rate of every day, in one array: each quote holds from
    its day to the day before the next, the last one through ``until``.

    ``quotes`` is ``(rate_date, currency, usd_rate)``; NULL rates, days and currencies are no
    quotes. Of several quotes of a day the largest counts, whatever their order. Returns
    ``currency`` in capitals, ``first_day`` and ``rates``, 8 bytes a day: 20 years of all 180
    currencies are 11 MB. A table of daily rates will do for quotes, too.
    """
    known = quotes.filter(F.col("usd_rate").isNotNull() & F.col("rate_date").isNotNull() & F.col("currency").isNotNull())
    daily = known.groupBy(F.upper("currency").alias("currency"), F.col("rate_date").cast("date").alias("day")).agg(
        F.max(F.col("usd_rate").cast(RATE)).alias("rate"))
    # Bounded: a currency has a quote a day at most.
    rows = daily.groupBy("currency").agg(F.array_sort(F.collect_list(F.struct("day", "rate"))).alias("q"))
    end = F.date_add(until.cast("date"), 1)

    def held(q: Column, i: Column) -> Column:
        days = F.date_diff(F.coalesce(F.get("q", i + 1)["day"], end), q["day"])
        return F.array_repeat(q["rate"], F.greatest(days, F.lit(0)))

    return rows.select("currency", F.get("q", F.lit(0))["day"].alias("first_day"), F.flatten(F.transform("q", held)).alias("rates"))


def with_rate(df: DataFrame, rates: DataFrame, currency: str | Column, day: str, name: str) -> DataFrame:
    """The rate of a currency on a day from ``rates_by_currency``; a miss leaves NULL.

    Rows meet the one row of their currency; the day is a place in its array, found
    without a search and inside generated code.
    """
    code = F.col(currency) if isinstance(currency, str) else currency
    own = rates.select(*[F.col(c).alias(f"_{c}") for c in ("currency", "first_day", "rates")])
    rate = F.get("_rates", F.date_diff(F.col(day), F.col("_first_day")))
    return df.join(own, code == F.col("_currency"), "left").select(*[df[c] for c in df.columns if c != name], rate.alias(name))


def rate_or_one(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(1).cast(RATE))


def fx_convert(df: DataFrame, rates: DataFrame, currency: str | Column, day: str, amounts: dict[str, str]) -> DataFrame:
    """Add each amount in dollars at the dated rate; a missing rate counts as one."""
    rated = with_rate(df, rates, currency, day, "_rate")
    out = rated.select("*", *[convert(src, rate_or_one("_rate")).alias(dst) for dst, src in amounts.items()])
    return out.drop("_rate")


def with_fee_seed(orders: DataFrame, fees: DataFrame) -> DataFrame:
    """Terms of the payment method from the active fee rows, by method only.

    A method with several active rows fails the job: each of them would repeat its
    orders. Pass a written seed (``settle``): Spark then knows its size and sends it
    to the orders; a shuffle on a handful of methods would pile them up.
    """
    several = F.raise_error(F.concat(F.lit("several active fee rows for "), F.coalesce("payment_method", F.lit("NULL"))))
    terms = fees.groupBy("payment_method").agg(
        F.count("*").alias("_n"), *[F.max(c).alias(c) for c in ("fee_percent", "fixed_fee_usd")])
    percent = F.when(F.col("_n") > 1, several.cast("decimal(18,6)")).otherwise(F.col("fee_percent")).alias("fee_percent")
    terms = terms.select("payment_method", percent, "fixed_fee_usd")
    return orders.join(terms, "payment_method", "left")


def active(seed: DataFrame) -> DataFrame:
    return seed.filter("is_active")


def with_header(items: DataFrame, header: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of the parent order on every child row; orphans keep NULL."""
    keys = ["site_code", "woo_order_id"]
    return items.join(header.select(*keys, *columns), keys, "left")


# Foreign keys every fact takes from its order header.
INHERITED = ["country_sk", "customer_sk", "payment_method_sk"]


def inherit_keys(df: DataFrame, fact_order: DataFrame) -> DataFrame:
    return with_header(df, fact_order, INHERITED)


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_anti")


def enrich(codes: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    return codes.join(seed, key, "left")


def covered(df: DataFrame, having: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(having.select(*keys), keys, "left_semi")


def flag_member(df: DataFrame, having: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Whether the key occurs in the other table."""
    marks = having.select(*keys).distinct().withColumn(name, F.lit(True))
    return df.join(marks, keys, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def full_outer_on(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of either side once, with the columns of both."""
    return a.join(b, keys, "full_outer")


def between_dates(fact: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of a date-key range; plain literals, so the Parquet scan can skip."""
    return fact.filter(F.col("date_sk").between(first, last))
