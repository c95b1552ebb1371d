"""Registry of demo queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def demo(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that gives the same rows."""
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(configure(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap
