"""Equi-joins with checks, group statistics beside rows, and pair counts.

No broadcast is forced.  Small sides reach the planner as written tables of known
size, and Spark broadcasts them below ``spark.sql.autoBroadcastJoinThreshold``;
above it the join shuffles and adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.scratch import materialize

#: Item pairs of one group that a task counts; wider groups are dealt out to more tasks.
PAIRS_A_TASK = 100_000


class RepeatedKeyError(ValueError):
    """A join side that was declared unique repeats a key."""


def require_unique(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """The same rows, written once; raises when a key repeats.  Check and join both read the written table."""
    df = materialize(df, f"unique-{side}")
    repeated = df.groupBy(*keys).agg(F.count("*").alias("key_rows")).where("key_rows > 1")
    found = repeated.head(1)
    if found:
        raise RepeatedKeyError(f"{side} side repeats {found[0].asDict()}")
    return df


def inner_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], unique_left: bool = False, unique_right: bool = False
) -> DataFrame:
    """Inner equi-join; sides that are declared unique are checked first."""
    if unique_left:
        left = require_unique(left, keys, "left")
    if unique_right:
        right = require_unique(right, keys, "right")
    return left.join(right, list(keys), "inner")


def join_report(left: DataFrame, right: DataFrame, keys: Sequence[str], nullable: str) -> DataFrame:
    """One row: key types, rows before and after an inner join, repeated keys on each side and NULLs it carried over.

    Worked out from rows per key, so the joined rows are never produced.
    ``nullable`` is a column of the right side.
    """
    keys = list(keys)
    per_left = left.groupBy(*keys).agg(F.count("*").alias("l"))
    per_right = right.groupBy(*keys).agg(F.count("*").alias("r"), F.count_if(F.col(nullable).isNull()).alias("m"))
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    left_n, right_n = F.coalesce("l", F.lit(0)), F.coalesce("r", F.lit(0))
    pairs = F.when(present, left_n * right_n).otherwise(0)

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    return per_left.join(per_right, keys, "full").agg(
        total(left_n).alias("left_rows"),
        total(right_n).alias("right_rows"),
        total(F.greatest(left_n - 1, F.lit(0))).alias("left_repeats"),
        total(F.greatest(right_n - 1, F.lit(0))).alias("right_repeats"),
        total(pairs).alias("joined_rows"),
        total(F.greatest(pairs - 1, F.lit(0))).alias("joined_repeats"),
        total(F.when(present, left_n * F.coalesce("m", F.lit(0))).otherwise(0)).alias("joined_missing"),
        *(
            F.lit(", ".join(kind for key in keys for name, kind in side.dtypes if name == key)).alias(f"{label}_key_types")
            for label, side in (("left", left), ("right", right))
        ),
    )


def attach_group_stats(df: DataFrame, groups: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """Group aggregates beside every row.

    The windowed spelling would move each group into one task.  Here the groups
    are aggregated map-side first, written, and joined back: usually a measured
    broadcast, so the rows themselves do not move at all.
    """
    groups = list(groups)
    right = df.groupBy(*groups).agg(*[column.alias(name) for name, column in stats.items()])
    right = materialize(right.withColumnsRenamed({g: f"__g_{g}" for g in groups}), "group-stats")
    same = [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in groups]
    return df.join(right, same, "inner").drop(*[f"__g_{g}" for g in groups])


def pair_counts(
    left: DataFrame, right: DataFrame, on: str, left_item: str, right_item: str, min_count: int, count: str
) -> DataFrame:
    """For each (left item, right item): in how many ``on`` groups both occur, if at least ``min_count``.

    Repeated items of a group are folded, and items that occur in fewer than
    ``min_count`` groups go first, as no pair of theirs can qualify.  The left
    items of a group are dealt out to one task for every ``PAIRS_A_TASK`` of its
    pairs, and its right items go to each of them; pairs are counted where they
    are made, before anything moves.
    """

    def occurrences(df: DataFrame, item: str, name: str) -> DataFrame:
        # written, as pruning reads it twice
        rows = df.select(F.col(on).alias("__k"), F.col(item).alias(name)).na.drop().distinct()
        rows = materialize(rows, f"pair{name}")
        enough = rows.groupBy(name).agg(F.count("*").alias("__n")).where(F.col("__n") >= min_count)
        return rows.join(enough.select(name), name, "left_semi")

    lefts, rights = occurrences(left, left_item, "__a"), occurrences(right, right_item, "__b")
    widths = (
        lefts.groupBy("__k").agg(F.count("*").alias("__x"))
        .join(rights.groupBy("__k").agg(F.count("*").alias("__y")), "__k")
        .select("__k", F.ceil(F.col("__x") * F.col("__y") / PAIRS_A_TASK).cast("int").alias("__tasks"))
    )
    dealt = lefts.join(widths, "__k").withColumn("__task", F.pmod(F.xxhash64("__a"), F.col("__tasks")).cast("int"))
    copied = rights.join(widths, "__k").withColumn("__task", F.explode(F.sequence(F.lit(0), F.col("__tasks") - 1)))
    pairs = dealt.join(copied, ["__k", "__task"]).groupBy("__a", "__b").agg(F.count("*").alias(count))
    return pairs.where(F.col(count) >= min_count).select(
        F.col("__a").alias(left_item), F.col("__b").alias(right_item), F.col(count).cast("bigint").alias(count)
    )
