"""Collects queries with the SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import feed_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EXPECTED: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a callable (spark, sf_dir) -> DataFrame under ``name``."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            EXPECTED[name] = sql
        return function

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Float averages depend on summation order in the last digits."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def with_sql(*ctes: str, select: str) -> str:
    """``WITH`` clause from feed names and ready-made CTE texts."""
    return "WITH " + ",\n".join(feed_sql(c) if c.isidentifier() else c for c in ctes) + "\n" + select


def mean_sql(column: str, digits: int) -> str:
    """Mean of a whole-number column rounded half up in whole-number arithmetic."""
    scale = 10**digits
    total, n = f"CAST(sum({column}) AS HUGEINT)", f"count({column})"
    return f"CAST((2 * {scale} * {total} + {n}) // (2 * {n}) AS DOUBLE) / {scale}"
