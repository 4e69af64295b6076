"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

1. Every task permutes its rows (a sort by a seeded hash of the whole row) and writes
   them to the shared folder with their place, so a lost executor changes nothing.
2. The matrix of row counts from part to shard is drawn from its exact law: column sums
   are the shard sizes, row sums the part sizes.  The driver draws it for groups of
   parts only; each group draws its own parts in a task.
3. The rows of a part are dealt to shards in its permuted order, as many as the matrix
   says, and exchanged once by (shard, bucket).
4. Buckets are permuted again; slots run on through the buckets of a shard.

Defined results: shard sizes differ by at most one row and depend on the row count
alone; slots run from 0 without gaps; null columns, null texts and equal rows are rows
like any other (equal rows are interchangeable); an empty table gives no row; columns
of the input named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.scratch import materialize

#: ``monotonically_increasing_id`` keeps the row number of a task in so many low bits.
ROW_BITS = 33


def draw(good: int, bad: int, taken: int, rng: np.random.Generator) -> int:
    """How many of ``taken`` rows drawn without replacement are good: rejection for log-concave laws, any population.

    Around the mode m with probability p the law lies below p * min(1, exp(w - p * |x - m|)), w = 1 + p / 2.
    """
    low, high = max(0, taken - bad), min(taken, good)
    if low == high:
        return low

    def log_weight(x: int) -> float:
        return -(math.lgamma(x + 1) + math.lgamma(good - x + 1) + math.lgamma(taken - x + 1) + math.lgamma(bad - taken + x + 1))

    mode = min(high, max(low, (taken + 1) * (good + 1) // (good + bad + 2)))
    top = log_weight(mode)
    total = good + bad
    norm = (math.lgamma(good + 1) + math.lgamma(bad + 1) + math.lgamma(taken + 1) + math.lgamma(total - taken + 1)
            - math.lgamma(total + 1))
    p = math.exp(min(0.0, top + norm))
    w = 1 + p / 2
    while True:
        u, v, sign = rng.random(), rng.random(), 1 if rng.random() < 0.5 else -1
        y = (rng.random() * w if u <= w / (1 + w) else w + rng.exponential()) / p
        x = mode + sign * int(y + 0.5)
        if low <= x <= high and v * min(1.0, math.exp(w - p * y)) <= math.exp(log_weight(x) - top):
            return x


def draw_matrix(parts: list[int], shards: list[int], rng: np.random.Generator) -> list[list[int]]:
    """Counts from each part to each shard: row sums ``parts``, column sums ``shards``, law of a uniform permutation."""
    left, matrix = list(shards), []
    for size in parts:
        row, rest, total = [], size, sum(left)
        for column in left:
            total -= column
            row.append(draw(column, total, rest, rng))
            rest -= row[-1]
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart, the larger ones first."""
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def shuffle_into_shards(df: DataFrame, shards: int = 16, seed: int = 0, groups: int = 256, bucket_rows: int = 1_000) -> DataFrame:
    """All rows and columns of ``df`` plus ``shard`` (int) and ``slot`` (long)."""
    kept = [name for name in df.columns if name not in ("shard", "slot")]
    named = df.select(*(F.col(f"`{name}`") for name in kept)) if len(kept) < len(df.columns) else df
    plain = named.toDF(*(f"__{i}" for i in range(len(kept))))
    whole_row = F.xxhash64(F.lit(seed), *(F.to_json(F.struct(c)) if "map" in kind else F.col(c) for c, kind in plain.dtypes))
    placed = materialize(
        plain.withColumn("__order", whole_row).sortWithinPartitions("__order").withColumn("__at", F.monotonically_increasing_id()),
        "shards-permuted",
    )
    part = F.shiftright("__at", ROW_BITS)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    sizes = materialize(sizes.withColumn("__group", F.pmod(F.xxhash64("__part"), F.lit(groups))), "shards-sizes")
    totals = {row["__group"]: row["n"] for row in sizes.groupBy("__group").agg(F.sum("__rows").alias("n")).collect()}
    rows, keys = sum(totals.values()), sorted(totals)
    by_group = draw_matrix([totals[k] for k in keys], shard_sizes(rows, shards), np.random.default_rng(seed))
    quota = dict(zip(keys, by_group))

    def ends(key, table):
        """Of each part of one group: where in its order each shard's rows end."""
        own = sorted(zip(table.column("__part").to_pylist(), table.column("__rows").to_pylist()))
        drawn = draw_matrix([n for _, n in own], quota[key[0].as_py()], np.random.default_rng([seed, key[0].as_py()]))
        return pa.table({
            "__part": pa.array([p for p, _ in own], pa.int64()),
            "__ends": pa.array([np.cumsum(row).tolist() for row in drawn], pa.list_(pa.int64())),
        })

    cuts = materialize(sizes.groupBy("__group").applyInArrow(ends, "__part long, __ends array<long>"), "shards-matrix")
    row = F.col("__at").bitwiseAND((1 << ROW_BITS) - 1)
    dealt = placed.withColumn("__part", part).join(cuts, "__part").withColumn(
        "__shard", F.size(F.filter("__ends", lambda end: end <= row)).cast("int")
    )
    buckets = max(1, math.ceil(rows / shards / bucket_rows))
    dealt = dealt.withColumn("__key", F.xxhash64(F.lit(seed), F.lit("second"), F.col("__at")))
    dealt = dealt.withColumn("__bucket", F.pmod(F.col("__key"), F.lit(buckets))).drop("__part", "__ends", "__order")
    begins = dealt.groupBy("__shard", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    # shards times buckets rows, one window a shard over its buckets
    begins = materialize(begins.withColumn(
        "__begin", F.sum("__n").over(Window.partitionBy("__shard").orderBy("__bucket")) - F.col("__n")
    ).drop("__n"), "shards-buckets")
    again = Window.partitionBy("__shard", "__bucket").orderBy("__key", "__at")
    slotted = dealt.withColumn("__slot", F.row_number().over(again).cast("long") - 1).join(begins, ["__shard", "__bucket"])
    return slotted.select(
        *(F.col(f"__{i}") for i in range(len(kept))), F.col("__shard").alias("shard"),
        (F.col("__slot") + F.col("__begin")).alias("slot"),
    ).toDF(*kept, "shard", "slot")
