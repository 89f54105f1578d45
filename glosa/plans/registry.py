"""Registry of runnable queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str | Callable[[], str]] = {}


def query(sql: str | Callable[[], str] | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL text (or a maker of it) that must agree."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def oracle_sql() -> dict[str, str]:
    return {name: sql() if callable(sql) else sql for name, sql in ORACLES.items()}


def oracle_sql_of(*names: str) -> dict[str, str]:
    """SQL of some queries, for SQL that is put together from theirs."""
    return {name: sql() if callable(sql := ORACLES[name]) else sql for name in names}
