"""Named queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def get(name: str) -> Query:
    try:
        return QUERIES[name]
    except KeyError:
        raise KeyError(f"unknown query {name!r}; known: {', '.join(sorted(QUERIES))}") from None
