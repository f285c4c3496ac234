"""Registered queries over the given tables, each with a DuckDB counterpart."""

from tallyhouse.queries import (  # noqa: F401  (importing registers)
    cleaning, landing, measuring, models, operating, periods,
)
from tallyhouse.queries import checking  # noqa: E402,F401  (its rules are stated over the models' SQL)
from tallyhouse.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
