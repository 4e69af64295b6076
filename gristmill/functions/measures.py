"""Labels, flags, buckets and derived numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of each season, and the order of seasons inside a calendar year.
SEASON_MONTHS = {"spring": (3, 4, 5), "summer": (6, 7, 8), "fall": (9, 10, 11)}
LAST_SEASON = "winter"
SEASON_ORDER = {"spring": 1, "summer": 2, "fall": 3, "winter": 4}


def two_way_label(condition: Column, yes: str, no: str) -> Column:
    """``yes`` where the condition holds, ``no`` elsewhere (also where it is NULL)."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def mapped(column: Column, mapping: Mapping) -> Column:
    """Value lookup; NULL where nothing matches."""
    result = None
    for key, value in mapping.items():
        matches = column == F.lit(key)
        result = F.when(matches, F.lit(value)) if result is None else result.when(matches, F.lit(value))
    return result


def bucket(conditions: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """Ordered threshold buckets: the first condition that holds wins."""
    (first, label), *rest = conditions
    result = F.when(first, F.lit(label))
    for condition, name in rest:
        result = result.when(condition, F.lit(name))
    return result.otherwise(F.lit(otherwise))


def season_of(day: Column) -> Column:
    """Season name of a date."""
    return bucket([(F.month(day).isin(*months), name) for name, months in SEASON_MONTHS.items()], LAST_SEASON)


def season_order(season: Column) -> Column:
    """Position of a season in its calendar year.

    Winter comes last although January and February open the year: a year's
    winter group holds its own January, February and December.
    """
    return mapped(season, SEASON_ORDER)


def floor_to_ten(column: Column) -> Column:
    """Decade or age band of a whole number, rounding down also below zero."""
    return (F.floor(column / 10) * 10).cast("bigint")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere (also where it is NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` for a positive bottom, NULL otherwise."""
    return F.when(bottom > 0, top / bottom)


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    """Ratio that is 0 when its bottom is 0."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))
