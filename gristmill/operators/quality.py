"""Profiles, rule counts, gates and grain checks.  Each report is one aggregation pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gristmill.functions.ordering import largest_first, smallest_first
from gristmill.operators.cleaning import key_counts, rows_of_duplicated_keys, violates
from gristmill.scratch import materialize


class GateError(ValueError):
    """A table failed its checks before loading."""


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, missing count and missing percentage (half-even, two digits)."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    one_row = df.agg(F.count("*").alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    ratio = F.bround(F.col("missing_count").cast("double") * 100 / F.col("__rows"), 2)
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("dtype"), F.col(c).alias("missing_count"), "__rows"
        )
        for c in columns
    ])
    return (
        one_row.select(F.inline(entries))
        .withColumn("missing_ratio", F.when(F.col("__rows") > 0, ratio))
        .drop("__rows")
    )


def missing_worst_first(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The profile without types, columns with most missing values first."""
    return (
        missing_profile(df, columns)
        .drop("dtype")
        .orderBy(largest_first("missing_count"), smallest_first("column_name"))
    )


def duplicate_sample(df: DataFrame, keys: Sequence[str], show: Sequence[str], rows: int = 10) -> DataFrame:
    """A few rows whose key repeats, sorted by key."""
    return rows_of_duplicated_keys(df.select(*show), keys).orderBy(*show).limit(rows)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows share their key, and how many repeat an earlier one."""
    counts = key_counts(df, keys)
    rows = F.col("key_rows")
    return counts.agg(
        F.coalesce(F.sum(F.when(rows > 1, rows)), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.coalesce(F.sum(rows - 1), F.lit(0)).cast("bigint").alias("repeat_rows"),
    )


def duplicate_summary(tables: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows that share their key, per named table."""
    parts = [
        duplicate_rows(df, keys).select(F.lit(name).alias("table_name"), "duplicate_rows")
        for name, df in tables.items()
    ]
    return union_all(parts)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Concatenate tables by column name."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rule name and how many rows break it."""
    names = list(rules)
    one_row = df.agg(*[F.count_if(violates(rules[name])).alias(f"v{i}") for i, name in enumerate(names)])
    entries = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"v{i}").alias("violations")) for i, name in enumerate(names)
    ])
    return one_row.select(F.inline(entries))


def load_gate(df: DataFrame, key: str, required: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """Checks before a table is loaded, as ``check`` / ``value`` rows.

    Rows are folded per key first (counts and violations are additive), so one
    shuffle of partial sums serves the repeat check and all the others.
    """
    parts = [F.count("*").alias("rows")]
    parts += [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in required]
    parts += [F.count_if(violates(rule)).alias(f"invalid_{name}") for name, rule in rules.items()]
    per_key = df.groupBy(F.col(key).alias("__key")).agg(*parts)
    checks = {
        "row_count": F.sum("rows"),
        f"duplicate_{key}": F.sum(F.col("rows") - 1),
        **{f"missing_{c}": F.sum(f"missing_{c}") for c in required},
        **{f"invalid_{name}": F.sum(f"invalid_{name}") for name in rules},
    }
    one_row = per_key.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in checks.items()])
    return one_row.unpivot([], list(checks), "check", "value")


def gated_write(
    df: DataFrame, key: str, required: Sequence[str], rules: Mapping[str, Column], write: Callable[[DataFrame], DataFrame] = materialize
) -> tuple[DataFrame, DataFrame]:
    """``write`` the table and check it on the way: what was written, and the rows of ``load_gate``.

    All counts but that of repeated keys are observed while the rows pass into the write, so the input is evaluated once.
    Repeated keys are counted over the key column of the written table.
    """
    counts = {
        "row_count": F.count("*"),
        **{f"missing_{c}": F.count_if(F.col(c).isNull()) for c in required},
        **{f"invalid_{name}": F.count_if(violates(rule)) for name, rule in rules.items()},
    }
    seen = Observation()
    written = write(df.observe(seen, *[c.alias(name) for name, c in counts.items()]))
    repeats = written.groupBy(key).agg((F.count("*") - 1).alias("more")).agg(F.coalesce(F.sum("more"), F.lit(0)).cast("bigint")).first()[0]
    values = {"row_count": seen.get["row_count"], f"duplicate_{key}": repeats, **seen.get}
    return written, df.sparkSession.createDataFrame(list(values.items()), "check string, value bigint")


def require_gate(gate: DataFrame) -> None:
    """Raise when any check other than the row count is not zero."""
    failed = {r["check"]: r["value"] for r in gate.collect() if r["check"] != "row_count" and r["value"]}
    if failed:
        raise GateError(f"checks failed: {failed}")


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], total: str = "total_rows") -> DataFrame:
    """One row: all rows, and the rows each condition holds for."""
    return df.agg(F.count("*").alias(total), *[F.count_if(c).alias(name) for name, c in conditions.items()])


def grain_repeats(df: DataFrame, grain: Sequence[str], detail: str, rows: str, details: str) -> DataFrame:
    """Grain values that cover several rows, with rows and distinct details in each."""
    return (
        df.groupBy(*grain)
        .agg(F.count("*").alias(rows), F.count_distinct(detail).alias(details))
        .where(F.col(rows) > 1)
    )


def grain_proof(df: DataFrame, grain: Sequence[str], names: tuple[str, str, str]) -> DataFrame:
    """One row: rows, distinct grain values and the difference.

    A grain value with a NULL part counts, as a row value does in SQL.
    """
    rows, distinct, repeats = names
    n = F.coalesce(F.sum("key_rows"), F.lit(0)).cast("bigint")
    return key_counts(df, grain).agg(
        n.alias(rows), F.count("*").alias(distinct), (n - F.count("*")).alias(repeats)
    )


def grain_proof_tables(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows, distinct keys and repeats per named table.  As COUNT(DISTINCT key), a NULL key is no key."""
    parts = []
    for name, df in tables.items():
        n = F.coalesce(F.sum("key_rows"), F.lit(0)).cast("bigint")
        proof = key_counts(df, [key]).agg(
            n.alias("row_count"), F.count(key).alias("title_count"), (n - F.count(key)).alias("duplicate_title_rows")
        )
        parts.append(proof.select(F.lit(name).alias("table_name"), "*"))
    return union_all(parts)


def compare_tables(tables: Mapping[str, DataFrame], key: str, flag: str) -> DataFrame:
    """Rows, distinct keys and flag rate per named table."""
    parts = [
        df.agg(
            F.count("*").alias("rows"),
            F.count_distinct(key).alias("unique_titles"),
            F.avg(flag).alias("long_run_rate"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return union_all(parts)


def extra_columns(wide: DataFrame, narrow: DataFrame) -> list[str]:
    """Columns only the first table has, sorted."""
    return sorted(set(wide.columns) - set(narrow.columns))


def load_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per loaded table and their total."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "*") for n, df in tables.items()]
    counts = union_all(parts)
    total = counts.agg(F.sum("row_count").cast("bigint").alias("row_count")).select(
        F.lit("total").alias("table_name"), "*"
    )
    return counts.unionByName(total)
