"""Where queries and their SQL meet."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tillbook.sources.sinks import ensure_local_root

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that returns the same rows where there is one."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = prepared(query)
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def prepared(query: Query) -> Query:
    """A registered query may store tables: a local session needs a folder for them."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_local_root(spark)
        return query(spark, sf_dir)

    return run
