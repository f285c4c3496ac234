"""Query registry: a Spark plan, its column kinds, and the SQL to compare with."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans.warehouse import Star, Warehouse
from tallyhouse.queries import adapter
from tallyhouse.queries.oracle_tables import TABLES
from tallyhouse.session import file_marks, pii_salt, shared_dir, size_shuffles, tune


class Run:
    """What a query may use: the given tables and the warehouse over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def wh(self) -> Warehouse:
        """Lazy tables, straight from the given files."""
        return Warehouse(adapter.inputs(self.spark, self.table))

    @cached_property
    def star(self) -> Star:
        """The published star: a table is written once per session and folder, when a query
        first reads it."""
        return Star(self.wh.inputs, self.spark, self.folder("star"))

    def model(self, name: str) -> DataFrame:
        """One table computed anew from the published tables it is built from."""
        return getattr(Warehouse, name).func(self.star)

    def folder(self, name: str) -> str:
        """A new folder for files of this run."""
        return f"{self.work}/{name}-{uuid.uuid4().hex[:12]}"

    @cached_property
    def work(self) -> str:
        return shared_dir(self.spark)


_runs: dict[tuple, Run] = {}

#: Files of the tables the shop is made of.
SHOP = r"/(customer|part|orders|lineitem)\.parquet(/|$)"


def run_for(spark: SparkSession, sf_dir: str) -> Run:
    tune(spark)
    pii_salt(spark, adapter.SALT)
    # New or changed files make a new run: nothing published before answers for them.
    marks = file_marks(spark, sf_dir)
    size_shuffles(spark, sum(size for path, size, _ in marks if re.search(SHOP, path)))
    key = (spark.sparkContext.applicationId, sf_dir, marks)
    if key not in _runs:
        _runs[key] = Run(spark, sf_dir)
    return _runs[key]


# kind -> (Spark cast, SQL cast). Both sides publish plain strings, integers,
# booleans and doubles; decimals are exact until this last step.
KINDS = {
    "s": (lambda c: c.cast("string"), "cast({0} as varchar)"),
    "i": (lambda c: c.cast("bigint"), "cast({0} as bigint)"),
    "b": (lambda c: c.cast("boolean"), "cast({0} as boolean)"),
    "m": (lambda c: c.cast("decimal(28,6)").cast("double"), "cast(cast({0} as decimal(28,6)) as double)"),
    "M": (lambda c: F.round(c.cast("decimal(28,6)"), 4).cast("double"), "cast(round(cast({0} as decimal(28,6)), 4) as double)"),
    "r": (lambda c: F.round(c.cast("double"), 6), "round(cast({0} as double), 6)"),
    "R": (lambda c: F.round(c.cast("double"), 4), "round(cast({0} as double), 4)"),
    "d": (lambda c: F.date_format(c, "yyyy-MM-dd"), "strftime(cast({0} as date), '%Y-%m-%d')"),
    "t": (lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"), "strftime(cast({0} as timestamp), '%Y-%m-%d %H:%M:%S')"),
}


def columns_of(spec: str) -> list[tuple[str, str]]:
    return [tuple(item.split(":")) for item in spec.split()]


def shape(df: DataFrame, spec: str) -> DataFrame:
    return df.select(*[KINDS[kind][0](F.col(f"`{name}`")).alias(name) for name, kind in columns_of(spec)])


def needed_tables(sql: str) -> list[str]:
    """Shared tables a statement mentions, each after those it is built from."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_]+\b", text)):
            if word in TABLES and word not in order:
                visit(TABLES[word])
                order.append(word)

    visit(sql)
    return order


def compose(sql: str, spec: str) -> str:
    ctes = ",\n".join(f"{name} as materialized (\n{TABLES[name]}\n)" for name in needed_tables(sql))
    picks = ",\n  ".join(f"{KINDS[kind][1].format(name)} as {name}" for name, kind in columns_of(spec))
    head = f"with {ctes}\n" if ctes else ""
    return f"{head}select\n  {picks}\nfrom (\n{sql}\n) as answer"


_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def query(name: str, spec: str, sql: str | None):
    """Register a plan builder ``Run -> DataFrame`` under a name."""

    def register(build: Callable[[Run], DataFrame]):
        if name in _queries:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shape(build(run_for(spark, sf_dir)), spec)

        _queries[name] = run
        if sql is not None:
            _oracles[name] = compose(sql, spec)
        return build

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)
