"""Frequencies, shares, correlations and supported group rates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.ordering import largest_first, smallest_first
from gristmill.operators.joins import attach_group_stats
from gristmill.scratch import materialize


def present_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Table-library grouping ignores rows whose key is missing."""
    return df.na.drop(subset=list(keys))


def sum_or_zero(column: str | Column) -> Column:
    """Table-library sum: 0 where SQL returns NULL for no values."""
    return F.coalesce(F.sum(column), F.lit(0))


def value_counts(df: DataFrame, column: str, count: str = "count") -> DataFrame:
    """Frequency of each present value."""
    return present_groups(df, [column]).groupBy(column).agg(F.count("*").alias(count))


def value_shares(df: DataFrame, column: str, count: str, ratio: str, scale: float = 1.0) -> DataFrame:
    """Frequency and share of the total, which is the sum of the written frequencies: the input is read once."""
    counts = materialize(df.groupBy(column).agg(F.count("*").alias(count)), "frequencies")
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(ratio, F.col(count) * scale / total)


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; ties go to the smaller value."""
    return value_counts(df, column, "__n").orderBy(largest_first("__n"), smallest_first(column)).limit(k).select(column)


def keep_top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose value is among the ``k`` most frequent ones."""
    df = materialize(df, "rows")  # read for the values and for the rows
    return df.join(top_values(df, column, k), column, "left_semi")


def _pearson(one: str, other: str) -> Column:
    """Correlation over the rows that hold both; NULL, not a division by zero, where one of them does not vary."""
    both = F.col(one).isNotNull() & F.col(other).isNotNull()
    x, y = F.when(both, F.col(one)), F.when(both, F.col(other))
    # merged deviations of equal values need not be zero, so their ends tell
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varies, F.try_divide(F.covar_pop(one, other), F.stddev_pop(x) * F.stddev_pop(y)))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation matrix in long form, every pair from one aggregation pass."""
    pairs = list(combinations(columns, 2))
    one_row = df.agg(*[_pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
                     *[_pearson(c, c).alias(f"d{i}") for i, c in enumerate(columns)])
    cells = [(c, c, f"d{i}") for i, c in enumerate(columns)]
    for i, (a, b) in enumerate(pairs):
        cells += [(a, b, f"r{i}"), (b, a, f"r{i}")]
    entries = F.array(*[
        F.struct(F.lit(a).alias("feature"), F.lit(b).alias("other"), F.col(r).alias("corr")) for a, b, r in cells
    ])
    return one_row.select(F.inline(entries))


def wide_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The matrix of :func:`correlations` for hundreds of columns, whose pairs no single aggregation could list.

    Every task adds up products of whole batches, a matrix each, and sends one row per pair; the rows are summed, so
    what is shuffled depends on tasks and columns, not on rows.  Values are taken from the columns' means, which one
    small aggregation before gives.  A pair counts the rows in which both are present.  NULL where fewer than two rows count
    or a column does not vary in them, NaN where a counted value is not finite.
    """
    columns = list(columns)
    own = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    finite = [F.when(F.abs(c) < float("inf"), F.col(c)) for c in own.columns]
    centre = np.array([m or 0.0 for m in own.agg(*[F.avg(c) for c in finite]).first()])
    sums = ["n", "odd", "sx", "sy", "xx", "yy", "xy"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), len(columns), len(columns)))
        for batch in batches:
            present = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            values = np.column_stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns])
            odd = ~np.isfinite(values)
            x = np.where((present > 0) & ~odd, values - np.where(odd, 0, centre), 0.0)
            square, strange = x * x, (odd & (present > 0)).astype(float)
            total += [
                present.T @ present, strange.T @ present + present.T @ strange, x.T @ present, present.T @ x,
                square.T @ present, present.T @ square, x.T @ x,
            ]
        i, j = np.divmod(np.arange(len(columns) ** 2), len(columns))
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32)} | dict(zip(sums, total.reshape(len(sums), -1))))

    parts = own.mapInArrow(summed, "i int, j int, " + ", ".join(f"{name} double" for name in sums))
    pairs = parts.groupBy("i", "j").agg(*[F.sum(name).alias(name) for name in sums])
    rows = F.nullif(F.col("n"), F.lit(0.0))
    spread_x, spread_y = (F.col(2 * v) - F.col(f"s{v}") * F.col(f"s{v}") / rows for v in "xy")
    varies = (F.col("n") > 1) & (spread_x > 1e-12 * F.col("xx")) & (spread_y > 1e-12 * F.col("yy"))
    value = F.try_divide(F.col("xy") - F.col("sx") * F.col("sy") / rows, F.sqrt(spread_x * spread_y))
    names = F.array(*[F.lit(c) for c in columns])
    return pairs.select(
        F.get(names, "i").alias("feature"), F.get(names, "j").alias("other"),
        F.when(F.col("odd") > 0, F.lit(float("nan"))).when(varies, value).alias("corr"),
    )


def correlations_with(df: DataFrame, columns: Sequence[str], target: str, name: str) -> DataFrame:
    """Correlation of each column with the target, strongest first whatever its sign."""
    one_row = df.agg(*[_pearson(c, target).alias(c) for c in columns])
    return one_row.unpivot([], list(columns), "feature", name).orderBy(
        largest_first(F.abs(name)), smallest_first("feature")
    )


def supported_rate(
    df: DataFrame, group: str, key: str, flag: str, min_count: int = 5,
    count: str = "content_count", rate: str = "long_run_rate",
) -> DataFrame:
    """Rate of a 0/1 flag per group, only for groups with at least ``min_count`` rows."""
    return (
        present_groups(df, [group])
        .groupBy(group)
        .agg(F.count(key).alias(count), F.avg(flag).alias(rate))
        .where(F.col(count) >= min_count)
        .orderBy(largest_first(rate), largest_first(count), smallest_first(group))
    )


def above_group_average(df: DataFrame, groups: Sequence[str], value: str, average: str) -> DataFrame:
    """Rows whose value exceeds the average of their group, with that average."""
    return attach_group_stats(df, groups, {average: F.avg(value)}).where(F.col(value) > F.col(average))
