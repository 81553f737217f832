"""The place queries register themselves, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, less a trailing ``_query``."""
    def register(function: Query) -> Query:
        key = function.__name__.removesuffix("_query")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register
