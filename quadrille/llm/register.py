"""Where the queries of this subpackage are entered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
