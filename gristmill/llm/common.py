"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, chosen by exact name and position, so that columns such as ``Text`` beside ``text`` do no harm."""
    at = [df.columns.index(name) for name in names]
    plain = df.toDF(*(f"__{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"__{i}").alias(name) for i, name in zip(at, names)))


def with_number(df: DataFrame, names: tuple[str, ...], extra) -> DataFrame:
    """All columns of ``df`` under safe names ``__0 ..``, plus what ``extra`` makes of a map from name to safe name."""
    plain = df.toDF(*(f"__{i}" for i in range(len(df.columns))))
    return plain.withColumns(extra({name: F.col(f"__{df.columns.index(name)}") for name in names}))


def restored(plain: DataFrame, df: DataFrame) -> DataFrame:
    """Undo the renaming of ``with_number`` and drop what was added."""
    return plain.select(*(F.col(f"__{i}") for i in range(len(df.columns)))).toDF(*df.columns)


def row_key(id_column: Column, text: Column) -> Column:
    """64-bit name of a document: its id and its text."""
    return F.xxhash64(id_column.cast("string"), text)


def texts(values: pa.Array) -> Iterator[str]:
    """Whole texts of an Arrow column; null is the empty text, bytes that are no UTF-8 become U+FFFD."""
    for value in values.cast(pa.binary()):
        raw = value.as_py()
        yield raw.decode("utf-8", "replace") if raw else ""


def raw_bytes(values: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of an Arrow text column; null is empty."""
    for value in values.cast(pa.binary()):
        yield value.as_py() or b""


def chunks(values: Iterator, most: int) -> Iterator[list]:
    """Consecutive values in lists of about ``most`` characters or bytes in all; one longer value stands alone."""
    own, size = [], 0
    for value in values:
        if own and size + len(value) > most:
            yield own
            own, size = [], 0
        own.append(value)
        size += len(value) + 1
    if own:
        yield own


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def broadcast_below(df: DataFrame, rows: int, of: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast only if a count shows at most ``rows`` rows (of ``of``, where rows of ``df`` gather many); beyond, the planner shuffles."""
    counted = df if of is None else of
    return F.broadcast(df) if counted.limit(rows + 1).count() <= rows else df
