"""Registry of named queries over the test tables, each with its DuckDB oracle.

A query is ``fn(spark, sf_dir) -> DataFrame``; its oracle is SQL over views of
the same parquet tables. Queries without an oracle (random or iterative fits)
are checked by row count only and by their own tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register
