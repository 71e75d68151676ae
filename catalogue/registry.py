"""Registered queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)`` under ``name``."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def rounded(value: Column | str, decimals: int = 6) -> Column:
    """Rounded for comparison, without a negative zero."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("double"), decimals) + F.lit(0.0)


def r(expression: str, decimals: int = 6) -> str:
    """SQL twin of :func:`rounded`."""
    return f"round({expression}, {decimals}) + 0.0"
