"""Top rows per group, first row per key, neighbours and frames.

Top-N filters keep at most N rows per group *before* the shuffle (Spark adds a
group limit in front of it), so a group that holds most of the table costs one
task no more than N rows from each mapper.  Neighbour and frame operators number
the rows of a group first (``operators.ordered``) and then look at blocks of
them with the few rows in front that a frame reaches, so a group of any size,
or the whole table as one, is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gristmill.functions.ordering import sql_asc, sql_desc
from gristmill.operators.joins import attach_group_stats
from gristmill.operators.ordered import positions, totals_before
from gristmill.scratch import materialize

BLOCK_ROWS = 100_000


def top_rows(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, number: str = "row_num"
) -> DataFrame:
    """The first ``n`` rows of every group by ``order`` (unique), numbered from 1."""
    window = Window.partitionBy(*groups).orderBy(*order)
    top = df.withColumn(number, F.row_number().over(window)).where(F.col(number) <= n)
    return top.withColumn(number, F.col(number).cast("bigint"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key by ``order`` (unique)."""
    return top_rows(df, keys, order, 1, "__first").drop("__first")


def top_ranks(
    df: DataFrame, groups: Sequence[str], value: str, n: int, rank: str, descending: bool = True, low: int = 1
) -> DataFrame:
    """Rows whose RANK by ``value`` inside their group lies in ``low`` .. ``n``, ties included.

    RANK has no bound on tied rows, so it is worked out on distinct values: one
    row per (group, value) with its count, of which only ``n`` per group can
    matter.  The ranks are then joined back to the rows.
    """
    groups = list(groups)
    order = sql_desc(value) if descending else sql_asc(value)
    values = df.groupBy(*groups, value).agg(F.count("*").alias("__ties"))
    if groups:
        best = top_rows(values, groups, [order], n, "__n")
    else:
        # a plain sort and limit needs no window, and then only n rows are numbered
        best = values.orderBy(order).limit(n).withColumn("__n", F.row_number().over(Window.orderBy(order)))
    so_far = Window.partitionBy(*groups).orderBy("__n").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        best.withColumn(rank, (F.coalesce(F.sum("__ties").over(so_far), F.lit(0)) + 1).cast("bigint"))
        .where(F.col(rank).between(low, n))
        .drop("__ties", "__n")
    )
    ranked = materialize(ranked, "top-ranks")  # its size is known then
    right = ranked.withColumnsRenamed({c: f"__r_{c}" for c in [*groups, value]})
    same = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in [*groups, value]]
    return df.join(right, same, "inner").drop(*[f"__r_{c}" for c in [*groups, value]])


def page(df: DataFrame, order: Sequence[Column], offset: int, limit: int) -> DataFrame:
    """``limit`` rows of the sorted table after skipping ``offset``."""
    return df.orderBy(*order).offset(offset).limit(limit)


def _in_blocks(df: DataFrame, groups: Sequence[str], order: Sequence[Column], before: int, after: int) -> tuple[DataFrame, WindowSpec]:
    """Rows numbered in their group and cut into blocks of ``BLOCK_ROWS``, and a window over a block.

    The ``before`` last rows of a block stand again in front of the next one, the ``after`` first behind the one before;
    ``__own`` tells a block's rows from such copies.
    """
    return _dealt(positions(df, groups, order, "__at"), before, after), _block_window(groups)


def _dealt(numbered: DataFrame, before: int, after: int) -> DataFrame:
    if max(before, after) > BLOCK_ROWS:
        raise ValueError(f"a frame may reach over {BLOCK_ROWS} rows")
    place = F.col("__at") - 1
    block, inside = F.floor(place / BLOCK_ROWS), place % BLOCK_ROWS
    homes = F.array_compact(F.array(
        block, F.when(inside >= BLOCK_ROWS - before, block + 1), F.when((inside < after) & (block > 0), block - 1)
    ))
    return numbered.withColumn("__block", F.explode(homes)).withColumn("__own", F.col("__block") == block)


def _block_window(groups: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*groups, "__block").orderBy("__at")


def _own_rows(df: DataFrame) -> DataFrame:
    return df.where("__own").drop("__at", "__block", "__own")


def neighbours(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    value: str,
    previous: str | None = None,
    following: str | None = None,
    change: str | None = None,
) -> DataFrame:
    """Value of the previous and next *present* row of a series, and the change from the previous; ``order`` is unique."""
    dealt, window = _in_blocks(df, groups, order, 1, 1 if following else 0)
    if previous:
        dealt = dealt.withColumn(previous, F.lag(value).over(window))
    if following:
        dealt = dealt.withColumn(following, F.lead(value).over(window))
    if change:
        dealt = dealt.withColumn(change, F.col(value) - F.lag(value).over(window))
    return _own_rows(dealt)


def ends_of_series(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], value: str, first: str, last: str
) -> DataFrame:
    """First and last value of the whole series beside each row; ``order`` is unique."""
    numbered = materialize(positions(df, groups, order, "__at"), "numbered")
    ends = {first: F.min_by(value, "__at"), last: F.max_by(value, "__at")}
    if groups:
        return attach_group_stats(numbered, groups, ends).drop("__at")
    return numbered.crossJoin(numbered.agg(*[c.alias(n) for n, c in ends.items()])).drop("__at")  # beside one row


def running(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], value: str, total: str, by_range: Sequence[str] = ()
) -> DataFrame:
    """Running sum along a series; ``order`` is unique, or names the ``by_range`` columns, whose equal values are added together."""
    if by_range:
        levels = df.groupBy(*groups, *by_range).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    else:
        levels = df.withColumns({"__sum": F.col(value), "__n": F.when(F.col(value).isNull(), 0).otherwise(1)})
    summed = totals_before(levels, groups, order, {"__sum_before": "__sum", "__n_before": "__n"})
    so_far = F.when(F.col("__n_before") + F.col("__n") > 0, F.col("__sum_before") + F.coalesce("__sum", F.lit(0)))
    summed = summed.withColumn(total, so_far).drop("__sum", "__n", "__sum_before", "__n_before")
    if not by_range:
        return summed
    keys = [*groups, *by_range]
    right = summed.select(*[F.col(c).alias(f"__r_{c}") for c in keys], total)
    same = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in keys]
    return df.join(right, same, "inner").drop(*[f"__r_{c}" for c in keys])


def moving(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], value: str, rows: int, functions: dict[str, str]
) -> DataFrame:
    """Aggregates (output name -> avg, min, max, sum, count) over the current and ``rows - 1`` earlier rows; ``order`` is unique."""
    dealt, window = _in_blocks(df, groups, order, rows - 1, 0)
    frame = window.rowsBetween(1 - rows, Window.currentRow)
    return _own_rows(dealt.withColumns({out: getattr(F, name)(value).over(frame) for out, name in functions.items()}))


def along(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    frames: Mapping[str, tuple[str, str, int, int]],
    totals: Mapping[str, str] = {},
    ends: Mapping[str, tuple[str, str]] = {},
) -> DataFrame:
    """Several looks along one series, for which the rows are sorted, numbered and dealt to blocks once; ``order`` is unique.

    ``frames`` maps output names to (avg, min, max, sum or count, column, first row, last row), the rows counted from
    the current one: ``("max", "x", -1, -1)`` is the previous value.  ``totals`` maps names of running sums to their columns,
    ``ends`` columns to the names of their first and last value.  Sums and ends of whole blocks come from one
    short row a block, so the rows themselves pass one shuffle for their numbers and one for the blocks.
    """
    groups = list(groups)
    numbered = positions(df, groups, order, "__at")
    window = _block_window(groups)
    before = max([0, *(-first for _, _, first, _ in frames.values())])
    after = max([0, *(last for _, _, _, last in frames.values())])
    dealt = _dealt(numbered, before, after)
    # copies of other blocks' rows count in frames only
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    looks = {out: getattr(F, name)(c).over(window.rowsBetween(first, last)) for out, (name, c, first, last) in frames.items()}
    looks |= {out: F.sum(F.when(F.col("__own"), F.col(c))).over(so_far) for out, c in totals.items()}
    looked = dealt.withColumns(looks).where("__own")
    if not (totals or ends):
        return _own_rows(looked)

    blocks = numbered.groupBy(*groups, F.floor((F.col("__at") - 1) / BLOCK_ROWS).alias("__block"))
    blocks = blocks.agg(
        F.count("*").alias("__rows"),
        *[F.sum(c).alias(f"__sum_{out}") for out, c in totals.items()],
        *[F.min_by(c, "__at").alias(first) for c, (first, _) in ends.items()],
        *[F.max_by(c, "__at").alias(last) for c, (_, last) in ends.items()],
    )
    in_group = Window.partitionBy(*groups).orderBy("__block")
    earlier = in_group.rowsBetween(Window.unboundedPreceding, -1)
    every = in_group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = blocks.select(
        *[F.col(c).alias(f"__c_{c}") for c in [*groups, "__block"]],
        *[F.sum(f"__sum_{out}").over(earlier).alias(f"__before_{out}") for out in totals],
        *[F.first(first).over(every).alias(first) for first, _ in ends.values()],
        *[F.last(last).over(every).alias(last) for _, last in ends.values()],
    )
    same = F.col("__block") == F.col("__c___block")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__c_{g}"))
    joined = looked.join(materialize(known, "blocks"), same)
    # NULL until the first value, as SUM is
    added = {out: F.coalesce(F.col(out) + F.col(f"__before_{out}"), F.col(out), F.col(f"__before_{out}")) for out in totals}
    dropped = [f"__c_{c}" for c in [*groups, "__block"]] + [f"__before_{out}" for out in totals]
    return _own_rows(joined.withColumns(added).drop(*dropped))
