"""Row-level cleaning and key-based deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators.windows import first_per_key


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which none of ``columns`` is NULL."""
    return df.na.drop(subset=list(columns))


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a constant per column."""
    return df.na.fill(dict(values))


def violates(rule: Column) -> Column:
    """A rule counts as violated only when it is true; a NULL comparison is no violation."""
    return F.coalesce(rule, F.lit(False))


def keep_valid(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Keep the rows that violate none of the named rules."""
    return df.where(~reduce(lambda a, b: a | b, (violates(rule) for rule in rules.values())))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which has to end in a unique column."""
    return first_per_key(df, keys, order)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, counted map-side first so that a hot key is one row per task."""
    return df.groupBy(*keys).agg(F.count("*").alias("key_rows"))


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return key_counts(df, keys).where("key_rows > 1")


def rows_of_duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key repeats.  A join, not a window: a hot key stays spread over tasks."""
    return df.join(duplicated_keys(df, keys).drop("key_rows"), list(keys), "left_semi")
