"""The tables of the star, built on demand from raw inputs.

``Warehouse`` builds each table once as a lazy DataFrame. ``Star`` writes the facts,
marts and dimensions as Parquet and reads them back, so lineage ends at each written
table and a lost executor costs one table's partitions at most. It writes a table when
it is first read, after the tables that one is built from; ``publish`` writes them all.
The declared row rules of a table are counted while it is written, and a fact is summed
by day when a period anchor first asks for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property
from threading import RLock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.keys import customer_hash, sk
from tallyhouse.operators.joins import INHERITED, active
from tallyhouse.session import settle
from tallyhouse.plans import days, dims, facts, marts, quality, recon, staging


@dataclass(frozen=True)
class Inputs:
    """Raw tables and seeds of one run."""

    orders: DataFrame
    lines: Callable[[], DataFrame]      # asked when lines are first read: their ids may take a job
    products: DataFrame
    refunds: DataFrame
    cost_sheet: DataFrame
    fx: DataFrame       # joins.rates_by_currency
    fees: DataFrame
    country_seed: DataFrame
    site_seed: DataFrame
    salt: str
    customers: DataFrame | None = None
    coupons: DataFrame | None = None

    @cached_property
    def order_items(self) -> DataFrame:
        return self.lines()


# Tables that are written, in waves: a table reads only tables of earlier waves.
# Typed orders and lines are written too, for six tables read them and each would
# parse the documents again.
WAVES = (
    ("stg_orders", "stg_order_items", "dim_site"),
    ("fact_order", "dim_date", "dim_country", "dim_payment_method", "dim_product", "dim_customer_anonymized"),
    ("fact_order_item", "fact_refund", "fact_order_cost"),
    ("mart_order_profit",),
    ("mart_product_profit", "mart_customer_summary"),
)
THREADS = 4


class Warehouse:
    """Lazy tables; override an attribute to read it from elsewhere."""

    def __init__(self, inputs: Inputs):
        self.inputs = inputs

    @cached_property
    def fx(self) -> DataFrame:
        """Written once, so that Spark knows the size and picks the join by it."""
        return settle(self.inputs.fx)

    @cached_property
    def fees(self) -> DataFrame:
        return settle(active(self.inputs.fees))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.inputs.orders, self.inputs.salt)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.inputs.order_items)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.inputs.products)

    @cached_property
    def stg_refunds(self) -> DataFrame:
        return staging.stg_refunds(self.inputs.refunds)

    @cached_property
    def stg_cost(self) -> DataFrame:
        return staging.stg_cost(self.inputs.cost_sheet)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.inputs.customers, self.inputs.salt)

    @cached_property
    def stg_coupons(self) -> DataFrame:
        return staging.stg_coupons(self.inputs.coupons)

    @cached_property
    def recon_unmatched_csv_cost(self) -> DataFrame:
        return recon.recon_unmatched_csv_cost(self.stg_cost, self.stg_orders)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date_spanning(self.stg_orders, "order_date", (self.stg_refunds, "refund_date"))

    @cached_property
    def dim_site(self) -> DataFrame:
        return dims.dim_site(self.inputs.site_seed)

    @cached_property
    def dim_country(self) -> DataFrame:
        return dims.dim_country(self.stg_orders, self.inputs.country_seed)

    @cached_property
    def dim_payment_method(self) -> DataFrame:
        return dims.dim_payment_method(self.stg_orders)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.stg_products, self.stg_order_items)

    @cached_property
    def dim_customer_anonymized(self) -> DataFrame:
        return dims.dim_customer_anonymized(self.stg_orders)

    @cached_property
    def fact_order(self) -> DataFrame:
        return facts.fact_order(self.stg_orders, self.fx, self.fees)

    @cached_property
    def fact_order_item(self) -> DataFrame:
        return _unpacked(facts.fact_order_item(self.stg_order_items, _packed(self.fact_order)))

    @cached_property
    def fact_refund(self) -> DataFrame:
        return _unpacked(facts.fact_refund(self.stg_refunds, _packed(self.fact_order), self.fx))

    @cached_property
    def fact_order_cost(self) -> DataFrame:
        return _unpacked(facts.fact_order_cost(self.stg_cost, _packed(self.fact_order), self.fx))

    @cached_property
    def mart_order_profit(self) -> DataFrame:
        return _unpacked(marts.mart_order_profit(
            _packed(self.fact_order_cost), self.fact_order, self.fact_order_item, self.fact_refund
        ))

    @cached_property
    def mart_product_profit(self) -> DataFrame:
        return _unpacked(marts.mart_product_profit(_packed(self.fact_order_item), self.mart_order_profit))

    @cached_property
    def mart_customer_summary(self) -> DataFrame:
        return marts.mart_customer_summary(
            self.stg_orders, self.fact_order_item, self.fact_refund, self.fact_order, self.mart_order_profit
        )


class Days(Mapping):
    """The facts' sums by day, each added up when it is first asked for."""

    def __init__(self, star: Star):
        self.star, self.held = star, {}

    def __getitem__(self, fact: str) -> DataFrame:
        if fact not in days.FACTS:
            raise KeyError(fact)
        with self.star.lock:
            if fact not in self.held:
                path = f"{self.star.path}/days/{fact}"
                days.append(getattr(self.star, fact), fact, path, batch_id=0)
                self.held[fact] = days.read(self.star.spark, fact, path)
        return self.held[fact]

    def __contains__(self, fact: object) -> bool:
        return fact in days.FACTS

    def __iter__(self) -> Iterator[str]:
        return iter(days.FACTS)

    def __len__(self) -> int:
        return len(days.FACTS)


class Star(Warehouse):
    """A warehouse whose tables are written under ``path`` when they are first read.

    ``days`` has each fact's sums by day, ``row_rules`` the rows and violations counted
    while the tables were written.
    """

    def __init__(self, inputs: Inputs, spark: SparkSession, path: str):
        super().__init__(inputs)
        self.spark, self.path, self.lock = spark, path, RLock()
        self.days = Days(self)
        self.written: dict[str, DataFrame] = {}
        self.counted: list[tuple[str, str, int]] = []

    def write(self, name: str) -> DataFrame:
        """Write a table that is not there yet, and read it back."""
        if name == "fact_order":
            # The customer's key passes the shuffle, not the e-mail hash it is made of, twice as long.
            keyed = self.stg_orders.withColumn("customer_sk", sk("customer_hash"))
            df = facts.fact_order(_dealt(keyed, "order_date"), self.fx, self.fees)
        else:
            df = getattr(Warehouse, name).func(self)
        if {"date_sk", *facts.ORDER} <= set(df.columns):
            df = df.sortWithinPartitions("date_sk")
        stored = _stored(df)
        found = _write(df, f"{self.path}/{name}", quality.row_rules_of(name), stored)
        self.counted.extend((name, rule, n) for rule, n in found.items())
        files = self.spark.read.schema(df.select(*stored).schema).parquet(f"{self.path}/{name}")
        self.written[name] = _shown(files, df.columns)
        return self.written[name]

    def write_all(self) -> Star:
        """Write every table not there yet; tables of a wave are written side by side."""
        with self.lock:
            self.fx, self.fees      # looked at once, before threads share them
            with ThreadPoolExecutor(THREADS) as pool:
                for wave in WAVES:
                    list(pool.map(self.write, [name for name in wave if name not in self.written]))
        return self

    @cached_property
    def row_rules(self) -> DataFrame:
        """Of all tables."""
        counted = sorted(self.write_all().counted)
        rules = self.spark.createDataFrame(counted, quality.COUNTED).coalesce(1)      # a row a declared rule
        rules.write.parquet(f"{self.path}/row_rules")
        return self.spark.read.schema(quality.COUNTED).parquet(f"{self.path}/row_rules")


def _on_demand(name: str) -> property:
    def get(star: Star) -> DataFrame:
        held = star.written.get(name)
        if held is not None:
            return held
        with star.lock:
            return star.written[name] if name in star.written else star.write(name)

    return property(get)


for _name in (name for wave in WAVES for name in wave):
    setattr(Star, _name, _on_demand(_name))


# Key texts that follow from ids beside them, and those of other tables: digests in hex.
MADE = {
    "order_sk": facts.ORDER,
    "order_cost_sk": facts.ORDER,
    "site_sk": ["site_code"],
    "order_item_sk": [*facts.ORDER, "woo_line_item_id"],
    "product_sk": facts.PRODUCT,
    "refund_sk": ["site_code", "woo_refund_id"],
}
# Further texts that need not lie in the files beside what they are made of.
TEXTS = {
    "order_natural_key": (facts.ORDER, lambda: F.concat("site_code", F.lit("-"), F.col("woo_order_id").cast("string"))),
    "customer_hash": (
        ["billing_email_hash", *facts.ORDER],
        lambda: customer_hash(F.lower(F.hex("billing_email_hash")), *facts.ORDER),
    ),
}
HEX = [*INHERITED, "billing_email_hash"]


def _made(columns: list[str]) -> dict[str, Column]:
    return {k: sk(*ids) for k, ids in MADE.items() if k in columns and set(ids) <= set(columns)}


def _packed(df: DataFrame) -> DataFrame:
    """The same columns for a join to move: keys that follow from ids beside them are left
    empty, digests of other tables are bytes. ``_unpacked`` puts the texts back."""
    empty = {k: F.lit(None).cast("string") for k in _made(df.columns)}
    return df.withColumns(empty | {k: F.unhex(k) for k in INHERITED if k in df.columns})


def _unpacked(df: DataFrame) -> DataFrame:
    texts = {k: F.lower(F.hex(k)) for k in INHERITED if k in df.columns}
    return df.withColumns(_made(df.columns) | texts)


def _stored(df: DataFrame) -> list[Column]:
    """The columns that are written: digests as bytes, and no text that follows from others."""
    left = {*_made(df.columns), *(k for k, (ids, _) in TEXTS.items() if set(ids) <= set(df.columns))}
    return [F.unhex(c).alias(c) if c in HEX else F.col(c) for c in df.columns if c not in left]


def _shown(files: DataFrame, columns: list[str]) -> DataFrame:
    """The written table with all its columns."""
    made = _made(columns) | {k: text() for k, (ids, text) in TEXTS.items() if set(ids) <= set(columns)}
    back = made | {k: F.lower(F.hex(k)) for k in HEX}
    return files.select(*[back[c].alias(c) if c in back else c for c in columns])


def _dealt(df: DataFrame, day: str = "date_sk") -> DataFrame:
    """Rows in ranges of dates, a file to a range: a date range then opens few files.

    Order ids split a day that is too large for one file. Key texts are random and would be
    most of what is moved: those that follow from ids are made behind the shuffle, the others
    pass it as bytes. Ranges are sampled, which computes what is dealt a second time: typed
    orders are dealt as they are read, and facts made of them behind it. Facts that come out
    of a join by order have been moved for it and are not dealt out again: their files are
    sorted by date, and a date range reads the pages of each that hold it.
    """
    return _shown(df.select(*_stored(df)).repartitionByRange(day, "woo_order_id"), df.columns)


def _write(df: DataFrame, path: str, rules: dict[str, Column], stored: list[Column] | None = None) -> dict[str, int]:
    """Write one table, or its ``stored`` columns. Returns the rows, and the violations of each rule: they are counted
    as the rows pass on to the files, so the table is not read for them. Digests in hex
    take half the bytes in zstd, and all of them in Spark's default.
    """
    counts, names = Observation(), {f"r{i}": name for i, name in enumerate(rules)}
    broken = [F.count_if(~F.coalesce(rules[name], F.lit(True))).alias(r) for r, name in names.items()]
    seen = df.observe(counts, F.count(F.lit(1)).alias("rows"), *broken).select(*(stored or ["*"]))
    seen.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    found = counts.get
    return {quality.ROWS: found["rows"], **{name: found[r] for r, name in names.items()}}


def publish(inputs: Inputs, path: str) -> Star:
    """The whole star, written under ``path``."""
    return Star(inputs, inputs.orders.sparkSession, path).write_all()
