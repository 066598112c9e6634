"""Registry of named queries and of the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None) -> Callable[[Query], Query]:
    """Registers a query under its function's name; ``sql`` is None where SQL cannot say it."""

    def add(query: Query) -> Query:
        if query.__name__ in QUERIES:
            raise ValueError(f"{query.__name__} is registered twice")
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add
