"""Runs a query and its expected SQL and compares rows; used by the tests and by hand."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir.rstrip('/')}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value + 0.0:.12g}")
    return value


def plain_row(values) -> tuple:
    return tuple(_plain(value) for value in values)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [plain_row(row[i] for i in order) for row in rows]
    return sorted(names), sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark_df, connection, sql) -> str | None:
    """None when columns and rows agree, else what differs."""
    got_names, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = connection.execute(sql)
    want_names, want = rows_of([c[0] for c in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{dict(zip(got_names, a))} != {dict(zip(got_names, b))}"
    return None
