"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its oracle (None: rows-only check)."""
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco
