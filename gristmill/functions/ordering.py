"""Sort orders with the place of NULLs spelled out.

Two conventions meet here: in SQL plans a NULL sorts as the largest value
(first when descending), in table-library plans it always comes last.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_desc(column: str | Column) -> Column:
    return F.desc_nulls_first(column)


def sql_asc(column: str | Column) -> Column:
    return F.asc_nulls_last(column)


def largest_first(column: str | Column) -> Column:
    return F.desc_nulls_last(column)


def smallest_first(column: str | Column) -> Column:
    return F.asc_nulls_last(column)
