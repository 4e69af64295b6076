"""Nested to rows, long to wide, wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.nested import literal_items
from gristmill.functions.ordering import largest_first, smallest_first
from gristmill.scratch import materialize


def explode_literal(
    df: DataFrame, key: str, column: str, fields: Mapping[str, tuple[str, str]], required: Sequence[str]
) -> DataFrame:
    """Literal-list text to one row per item.

    ``fields`` maps output names to (item key, ``bigint`` or ``string``).  Empty
    lists vanish, and so do items that miss one of the ``required`` outputs.
    """
    kinds = {source: kind for source, kind in fields.values()}
    items = df.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(
        key, F.explode(literal_items(F.col(column), kinds)).alias("__item")
    )
    flat = items.select(key, *[F.col("__item")[source].alias(name) for name, (source, _) in fields.items()])
    return flat.na.drop(subset=list(required))


def explode_list(df: DataFrame, items: Column, name: str) -> DataFrame:
    """One row per element of an array column expression."""
    return df.withColumn(name, F.explode(items))


def count_pivot(df: DataFrame, index: str, columns: str, counted: str, k: int) -> DataFrame:
    """Counts by index x the ``k`` most frequent column values, empty cells 0.

    Rows are folded to cells first, so they are read once.  The at most ``k``
    names are fetched because they become column names.
    """
    present = df.na.drop(subset=[index, columns])
    cells = materialize(
        present.groupBy(index, columns).agg(F.count("*").alias("__rows"), F.count(counted).alias("__n")), "pivot-cells"
    )
    leading = cells.groupBy(columns).agg(F.sum("__rows").alias("__rows"))
    order = [largest_first("__rows"), smallest_first(columns)]
    names = sorted(row[0] for row in leading.orderBy(*order).limit(k).select(columns).collect())
    kept = cells.where(F.col(columns).isin(names))
    return kept.groupBy(index).pivot(columns, names).agg(F.sum("__n")).na.fill(0)


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "value"):
    """Wide to long; all values become double so that they share one column."""
    cast = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return cast.unpivot(list(ids), list(values), name, value)
