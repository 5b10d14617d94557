"""Named queries, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add
