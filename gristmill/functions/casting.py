"""Lenient and strict casts for columns that arrive as text.

Lenient casts return NULL for anything that does not fit and never return NaN,
so "missing" has one spelling downstream.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANKS = f"[{WHITESPACE}]*"
NUMBER = rf"^{BLANKS}[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf(?:inity)?)){BLANKS}$"
DIGITS = r"\A[+-]?+[0-9.]++\z"
DAY = rf"^{BLANKS}\d{{4}}-\d{{1,2}}-\d{{1,2}}{BLANKS}$"
# Texts that count as true.
TRUE_TEXTS = ("true", "1", "t", "yes", "y")


def strip_text(column: Column) -> Column:
    """Remove every kind of leading and trailing whitespace, not only spaces."""
    return F.trim(column, F.lit(WHITESPACE))


def to_number(column: Column) -> Column:
    """Text to double; NULL unless the whole text is one decimal number or infinity.

    Most numbers are digits and points, which a plain cast reads right.  Only other texts are stripped and tested for
    their full shape: a plain cast reads ``'12d'`` as 12 and ``'nan'`` as NaN.
    """
    text = column.cast("string")
    return F.when(text.rlike(DIGITS), text.try_cast("double")).when(text.rlike(NUMBER), strip_text(text).try_cast("double"))


def to_real(column: Column) -> Column:
    """Loader variant of :func:`to_number`, which also allows ``1_000``."""
    text = column.cast("string")
    grouped = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    return to_number(F.when(text.contains("_"), grouped).otherwise(text))


def to_whole(column: Column) -> Column:
    """Text to bigint through double, truncating toward zero; NULL for infinities and overflow."""
    return to_real(column).try_cast("bigint")


def to_flag(column: Column) -> Column:
    """Text to boolean; missing counts as false."""
    return F.coalesce(F.lower(strip_text(column.cast("string"))).isin(*TRUE_TEXTS), F.lit(False))


def to_day(column: Column) -> Column:
    """Text like ``1995-10-30`` to date; NULL for any other shape and for days that do not exist."""
    text = column.cast("string")
    return F.when(text.rlike(DAY), strip_text(text).try_cast("date"))


def to_id(column: Column) -> Column:
    """Strict cast to bigint: raises on a value that does not fit, as a key cast should."""
    return column.cast("bigint")
