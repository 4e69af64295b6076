"""Positions, ranks, medians and AUC over groups of any size.

A window without PARTITION BY, or one over a column with two values, moves its
rows into one or two tasks.  The operators here sort by range instead: the
table is cut into ordered ranges of similar size, each range sums up on its
own, and every range learns what came before it from one small table of range
totals.  A group that holds a third of the rows simply spans many ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.ordering import smallest_first, sql_asc, sql_desc
from gristmill.operators.joins import attach_group_stats
from gristmill.scratch import materialize


def _ranges(df: DataFrame, groups: Sequence[str], order: Sequence[Column], names: Sequence[str]) -> DataFrame:
    """Rows in sorted ranges: ``__range`` numbers the range, ``__row`` counts on along its rows.

    Written once: range bounds come from a sample, so a second evaluation could cut elsewhere.
    """
    taken = {"__range", "__row", *names} & set(df.columns)
    if taken:
        raise ValueError(f"column names are needed here: {sorted(taken)}")
    sort = [*[smallest_first(g) for g in groups], *order]
    return materialize(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumns({"__range": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}),
        "ranges",
    )


def totals_before(df: DataFrame, groups: Sequence[str], order: Sequence[Column], totals: Mapping[str, str]) -> DataFrame:
    """Add to each row the sum of a column over the earlier rows of its group.

    ``totals`` maps output names to numeric columns.  ``groups`` plus ``order``
    must be unique, otherwise equal rows could not be spread over ranges.
    """
    groups = list(groups)
    ranges = _ranges(df, groups, order, ["__cell", *totals])
    cells = ranges.groupBy("__range", *groups).agg(*[F.sum(c).alias(name) for name, c in totals.items()])
    earlier = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # A range can continue one group only, so at most one row per range is left.
    carried = F.broadcast(
        cells.select(
            F.col("__range").alias("__c_range"),
            *[F.col(g).alias(f"__c_{g}") for g in groups],
            *[F.sum(name).over(earlier).alias(f"__c_{name}") for name in totals],
            F.row_number().over(Window.partitionBy(*groups).orderBy("__range")).alias("__cell"),
        )
        .where("__cell > 1")
        .drop("__cell")
    )
    same = F.col("__range") == F.col("__c_range")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__c_{g}"))
    inside = Window.partitionBy("__range", *groups).orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)
    local = ranges.withColumns({name: F.sum(c).over(inside) for name, c in totals.items()})
    zero = F.lit(0)
    return (
        local.join(carried, same, "left")
        .withColumns({n: F.coalesce(n, zero) + F.coalesce(f"__c_{n}", zero) for n in totals})
        .select(*df.columns, *totals)
    )


def positions(df: DataFrame, groups: Sequence[str], order: Sequence[Column], number: str) -> DataFrame:
    """ROW_NUMBER of every row inside its group; ``order`` ends in a unique column.

    Rows of a range are counted already, so a row's number is its place there, less that of the first row of
    its group in the range, and more by the group's rows in earlier ranges.  One row per range and group tells both; that
    table is written, so Spark broadcasts it if it is small and joins by range and group if it is not.
    """
    groups = list(groups)
    ranges = _ranges(df, groups, order, [number, "__shift"])
    earlier = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    cells = ranges.groupBy("__range", *groups).agg(F.min("__row").alias("__first"), F.count("*").alias("__rows"))
    shift = F.col("__first") - F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - 1
    cells = cells.select(
        F.col("__range").alias("__c_range"), *[F.col(g).alias(f"__c_{g}") for g in groups], shift.alias("__shift")
    )
    same = F.col("__range") == F.col("__c_range")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__c_{g}"))
    placed = ranges.join(materialize(cells, "cells"), same)
    return placed.select(*df.columns, (F.col("__row") - F.col("__shift")).alias(number))


def tiles(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, tile: str) -> DataFrame:
    """NTILE(n): near-equal slices of every group, the larger ones first."""
    numbered = positions(df, groups, order, "__number")
    if groups:
        numbered = materialize(numbered, "numbered")
        sized = attach_group_stats(numbered, groups, {"__rows": F.count("*")})
    else:
        numbered = materialize(numbered, "numbered")
        sized = numbered.withColumn("__rows", numbered.agg(F.count("*")).scalar())
    number, rows = F.col("__number"), F.col("__rows")
    small, larger = F.floor(rows / n), rows % n
    in_larger = number <= larger * (small + 1)
    slice_no = F.when(in_larger, F.ceil(number / (small + 1))).otherwise(
        larger + F.ceil((number - larger * (small + 1)) / F.greatest(small, F.lit(1)))
    )
    return sized.withColumn(tile, slice_no.cast("int")).drop("__number", "__rows")


def ranks(
    df: DataFrame, groups: Sequence[str], value: str, rank: str | None = None, dense: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """RANK and DENSE_RANK of every row inside its group by ``value``.

    Tied rows are folded into one (group, value) row with its count before the
    sort, and the ranks are joined back, so neither a hot group nor a hot value
    gathers in one task.
    """
    groups = list(groups)
    levels = df.groupBy(*groups, value).agg(F.count("*").alias("__ties")).withColumn("__one", F.lit(1))
    order = [sql_desc(value) if descending else sql_asc(value)]
    wanted = {**({rank: "__ties"} if rank else {}), **({dense: "__one"} if dense else {})}
    levels = totals_before(levels, groups, order, wanted)
    keys = [*groups, value]
    right = levels.select(
        *[F.col(c).alias(f"__r_{c}") for c in keys], *[(F.col(n) + 1).cast("bigint").alias(n) for n in wanted]
    )
    same = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in keys]
    return df.join(right, same, "inner").drop(*[f"__r_{c}" for c in keys])


def medians(df: DataFrame, groups: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Exact interpolated median of several columns per group, one column ``median_<name>`` each.

    ``median()`` keeps every distinct value of a group in one buffer; here the
    two middle values are picked from the ordered ranges.
    """
    groups = list(groups)
    long = df.select(*groups, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(
        groups, list(values), "__metric", "__value"
    ).where("__value IS NOT NULL")
    keys = [*groups, "__metric"]
    levels = long.groupBy(*keys, "__value").agg(F.count("*").alias("__ties"))
    before = materialize(totals_before(levels, keys, [smallest_first("__value")], {"__before": "__ties"}), "levels")
    sized = attach_group_stats(before, keys, {"__rows": F.sum("__ties")})
    low, high = F.floor((F.col("__rows") + 1) / 2), F.floor((F.col("__rows") + 2) / 2)

    def holds(position: Column) -> Column:
        inside = (position > F.col("__before")) & (position <= F.col("__before") + F.col("__ties"))
        return F.when(inside, F.col("__value")).otherwise(0.0)

    middle = sized.groupBy(*keys).agg((F.sum(holds(low) + holds(high)) / 2).alias("__median"))
    return middle.groupBy(*groups).agg(
        *[F.max(F.when(F.col("__metric") == v, F.col("__median"))).alias(f"median_{v}") for v in values]
    )


def smallest_share(df: DataFrame, group: str, order: Sequence[str], share: float, flag: str) -> DataFrame:
    """Flag the first ``round(share * rows)`` rows of every group by ``order`` (unique in its group)."""
    numbered = materialize(positions(df, [group], [smallest_first(c) for c in order], "__number"), "numbered")
    sized = attach_group_stats(numbered, [group], {"__rows": F.count("*")})
    return sized.withColumn(flag, F.col("__number") <= F.round(F.col("__rows") * share)).drop("__number", "__rows")


def smallest_hashes(df: DataFrame, group: str, digits: str, tie: str, share: float, flag: str, step: int = 4, steps: int = 2) -> DataFrame:
    """``smallest_share`` by a text of hexadecimal digits, equal ones by ``tie``, without a sort of the rows.

    The last row that gets the flag is looked for in histograms: rows counted by their first ``step`` digits tell in which
    bucket it stands, those of this bucket by the next ones, and so on.  Only the last bucket's rows, one in
    16 ** (step * steps) of a group, are put in order.  Counts are combined before the shuffle, a histogram has
    16 ** step rows a group, and the rows themselves only pass a filter.  The input is written once, as it is read several times.
    A missing text comes before all others.
    """
    rows = materialize(df.withColumn("__hex", F.coalesce(digits, F.lit(""))), "hashed")
    same = F.col(group).eqNullSafe(F.col("__group"))
    # of each group: the digits known so far, and which row of theirs is the last one
    found = rows.groupBy(F.col(group).alias("__group")).agg(F.round(F.count("*") * share).cast("bigint").alias("__wanted"))
    found = materialize(found.withColumn("__digits", F.lit("")), "wanted")
    for k in range(1, steps + 1):
        inside = rows.select(group, F.substring("__hex", 1, step * k).alias("__longer")).join(found, same)
        inside = inside.where(F.col("__longer").startswith(F.col("__digits")))
        counts = inside.groupBy("__group", "__longer", "__wanted").agg(F.count("*").alias("__rows"))
        upto = Window.partitionBy("__group").orderBy("__longer")
        counts = counts.withColumn("__upto", F.sum("__rows").over(upto)).where("__upto >= __wanted")
        best = counts.groupBy("__group").agg(F.min(F.struct("__longer", "__upto", "__rows", "__wanted")).alias("__b"))
        found = materialize(best.select(
            "__group", (F.col("__b.__wanted") - F.col("__b.__upto") + F.col("__b.__rows")).alias("__wanted"), F.col("__b.__longer").alias("__digits")
        ), "wanted")
    last = rows.select(group, "__hex", F.col(tie).alias("__tie")).join(found, same).where(F.col("__hex").startswith(F.col("__digits")))
    last = last.withColumn("__number", F.row_number().over(Window.partitionBy("__group").orderBy("__hex", "__tie"))).where("__number <= __wanted")
    last = last.groupBy("__group").agg(F.max(F.struct("__hex", "__tie")).alias("__last"))
    found = materialize(found.select("__group", "__digits").join(last.withColumnRenamed("__group", "__g"), F.col("__group").eqNullSafe(F.col("__g")), "left").drop("__g"), "last")
    before = F.col("__hex") < F.col("__digits")
    taken = before | (F.struct(F.col("__hex"), F.col(tie).alias("__tie")) <= F.col("__last"))
    flagged = rows.join(found, same, "left").withColumn(flag, F.when(F.col("__last").isNull(), F.coalesce(before, F.lit(False))).otherwise(taken))
    return flagged.select(*df.columns, flag)


def area_under_curve(df: DataFrame, score: str, actual: str, name: str = "auc") -> DataFrame:
    """Exact ROC AUC as one row: the share of (positive, negative) pairs that the score puts in order.

    Ties count half.  NULL when one of the classes is missing.
    """
    levels = (
        df.where(F.col(score).isNotNull() & F.col(actual).isNotNull())
        .groupBy(score)
        .agg(F.sum(F.col(actual).cast("bigint")).alias("__hits"), F.count("*").alias("__rows"))
        .withColumn("__misses", F.col("__rows") - F.col("__hits"))
    )
    below = totals_before(levels, [], [smallest_first(score)], {"__misses_below": "__misses"})
    pos, neg = F.col("__hits").cast("double"), F.col("__misses").cast("double")
    won = F.sum(pos * F.col("__misses_below") + pos * neg / 2)
    pairs = F.sum(pos) * F.sum(neg)
    return below.agg(F.when(pairs > 0, won / pairs).alias(name))
