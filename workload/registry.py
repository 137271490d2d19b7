"""Registry of checked queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.sql_views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_views(views, sql) if views else sql
        return function

    return register
