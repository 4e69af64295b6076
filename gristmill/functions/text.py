"""Join keys, damaged text, sentinel texts and delimited lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that only occur in text decoded with the wrong charset.
REPLACEMENT_MARK = "�"
DAMAGE_MARKS = ("�", "ÿ", "ã")


def join_key(column: Column) -> Column:
    """Normalised title: outer spaces removed, lower case."""
    return F.lower(F.trim(column))


def is_intact(column: Column, marks: tuple[str, ...] = (REPLACEMENT_MARK,)) -> Column:
    """True when the text is present and holds none of ``marks``."""
    return reduce(lambda ok, mark: ok & ~column.contains(mark), marks, column.isNotNull())


def sentinel_to_null(column: Column, sentinel: str = "nan") -> Column:
    """Files written by earlier steps spell missing text ``'nan'``."""
    return F.nullif(column, F.lit(sentinel))


def list_items(column: Column, separator: str = ",") -> Column:
    """Delimited text to an array of trimmed, non-empty items."""
    return F.filter(F.transform(F.split(column, separator), lambda item: F.trim(item)), lambda item: item != "")


def first_item(column: Column, separator: str = ",") -> Column:
    """First element of delimited text; NULL when it is blank."""
    return F.nullif(F.trim(F.split_part(column, F.lit(separator), F.lit(1))), F.lit(""))
