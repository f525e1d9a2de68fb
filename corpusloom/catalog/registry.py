"""The table of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None):
    """Register a function under its own name, without a ``_query`` ending."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__.removesuffix("_query")] = Query(fn, sql)
        return fn

    return add
