"""Exact top-k search by distributed histogram selection.

Vectors become blocks of whole numbers.  Every query block meets every block of rows
and everything is scored, several times over: each round counts the scores of each
query in a histogram of its current range and keeps the bin that holds the k-th
highest one, until that bin is one score wide.  A last pass keeps scores above it and,
of its ties, the smallest ids.  A task sends only bins from the top down to its own
k-th highest score (what lies lower cannot hold the k-th of all) and in the last pass at most
k rows a query, so a value shared by many rows costs no more than another one.

Defined results: vectors that are null, empty of components, or hold a null or a
non-finite component take no part; shorter vectors count as padded with zeros; rows
with the query's id are its own; every other row is a candidate, repeated ones each on their own; every
asked row is a query of its own, so an id asked by several rows has each rank as often; fewer candidates than k give all.  Components are
scaled and floored as doubles and must stay below 2**31 in size, else the job fails.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import pick
from gristmill.scratch import materialize

BINS = 256
BLOCK_SCHEMA = "ids binary, vectors binary, dims int, longest double"


def valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of up to ``size`` rows: ids, the matrix row by row, its width, and the largest length of a vector."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            own = batch.slice(start, size)
            vectors = own.column("vector")
            counts = np.diff(vectors.offsets.to_numpy())
            width = int(counts.max())
            matrix = np.zeros((own.num_rows, width), np.int64)
            matrix[np.arange(width) < counts[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
            if matrix.size and np.abs(matrix).max() >= 1 << 31:
                raise ValueError("a scaled component has 32 bits or more")
            yield pa.RecordBatch.from_pydict({
                "ids": pa.array([own.column("id").to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
                "vectors": pa.array([matrix.tobytes()], pa.binary()), "dims": pa.array([width], pa.int32()),
                "longest": pa.array([float(np.sqrt((matrix.astype(float) ** 2).sum(axis=1)).max())], pa.float64()),
            })


def _matrix(block: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(block[f"{side}ids"], np.int64), np.frombuffer(block[f"{side}vectors"], np.int64).reshape(-1, block[f"{side}dims"])


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where those are exact, else in whole numbers of any size."""
    width = min(queries.shape[1], rows.shape[1])
    queries, rows = queries[:, :width], rows[:, :width]
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * width
    if most < 1 << 53:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    if most < 1 << 63:
        return queries @ rows.T
    exact = queries.astype(object) @ rows.astype(object).T
    if max(abs(x) for x in exact.ravel()) >= 1 << 63:
        raise ValueError("a score has 64 bits or more")
    return exact.astype(np.int64)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Number of a query block, numbers and ids of its queries, the low ends of its ranges, and its scores against one block of rows without the queries' own."""
    for batch in batches:
        for block in batch.to_pylist():
            query_ids, queries = _matrix(block, "q_")
            row_ids, rows = _matrix(block, "")
            low = np.frombuffer(block["lows"], np.int64)[:, None]
            scores = _scores(queries, rows)
            numbers = np.frombuffer(block["q_numbers"], np.int64)
            yield block["q_block"], numbers, query_ids, low, scores, row_ids, query_ids[:, None] != row_ids[None, :]


def _histograms(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows (number of the query, bin, rows counted), bin BINS standing for everything above the range."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sent(numbers: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts  # in higher bins
        q, b = np.nonzero((counts > 0) & (above < k))
        return pa.RecordBatch.from_pydict({"query": numbers[q], "bin": b.astype(np.int32), "n": counts[q, b]})

    for block, numbers, _, low, scores, _, other in _met(batches):
        if block not in held:
            if len(held) >= 16:
                yield sent(*held.pop(next(iter(held))))
            held[block] = (numbers, np.zeros((len(numbers), BINS + 1), np.int64))
        bins = np.minimum((scores - low) // width, BINS)
        keep = other & (bins >= 0)
        cells = (np.arange(len(numbers))[:, None] * (BINS + 1) + bins)[keep]
        held[block][1][:] += np.bincount(cells, minlength=len(numbers) * (BINS + 1)).reshape(len(numbers), BINS + 1)
    for numbers, counts in held.values():
        yield sent(numbers, counts)


def _kept(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows with a score of at least the k-th highest, at most k a query and block: highest first, then smallest id."""
    for _, numbers, ids, low, scores, row_ids, other in _met(batches):
        q, r = np.nonzero(other & (scores >= low))
        found = scores[q, r]
        order = np.lexsort((row_ids[r], -found, q))
        q, r, found = q[order], r[order], found[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        q, r, found = q[place < k], r[place < k], found[place < k]
        yield pa.RecordBatch.from_pydict({"query": numbers[q], "query_id": ids[q], "vec_id": row_ids[r], "score": found})


def top_k(rows: DataFrame, asked: Column, k: int = 10, scale: float = 1024.0, id_column: str = "vec_id",
          vector_column: str = "embedding", query_block: int = 256, row_block: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest whole-number inner products of each asked row.

    ``asked`` is a condition on ``id_column`` that states the query set.
    """
    own = pick(rows, id_column, vector_column).where(valid(F.col(vector_column)) & F.col(id_column).isNotNull())
    own = own.select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(vector_column, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"), asked.alias("asked"),
    ).withColumn("number", F.monotonically_increasing_id())
    own = materialize(own, "topk-vectors")
    blocks = materialize(own.select("id", "vector").mapInArrow(lambda b: _blocks(b, row_block), BLOCK_SCHEMA), "topk-blocks")
    queries = own.where("asked").select("number", "id", "vector")
    n_queries = queries.count()
    n_blocks = max(1, math.ceil(n_queries / query_block))
    reach = blocks.agg(F.max("longest")).first()[0]
    if not n_queries or reach is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    half = math.ceil(reach * reach) + 1
    queries = queries.withColumn("q_block", F.pmod(F.xxhash64("number"), F.lit(n_blocks)).cast("int"))
    width = -(-(2 * half + 1) // BINS)
    lows = queries.select(F.col("number").alias("query"), F.lit(-half).cast("long").alias("low"))

    def met(lows: DataFrame) -> DataFrame:
        """Each query block beside each block of rows."""

        def packed(key, table):
            table = table.combine_chunks().sort_by("number")
            block = next(_blocks(iter(table.select(["id", "vector"]).to_batches()), table.num_rows))
            low = table.column("low").to_numpy().astype(np.int64).tobytes()
            return pa.table({
                "q_block": pa.array([key[0].as_py()], pa.int32()),
                "q_numbers": pa.array([table.column("number").to_numpy().astype(np.int64).tobytes()], pa.binary()), "q_ids": block.column("ids"), "q_vectors": block.column("vectors"),
                "q_dims": block.column("dims"), "lows": pa.array([low], pa.binary()),
            })

        asked_rows = queries.join(lows, queries["number"] == lows["query"]).select("q_block", "number", "id", "vector", "low")
        asked_blocks = asked_rows.groupBy("q_block").applyInArrow(
            packed, "q_block int, q_numbers binary, q_ids binary, q_vectors binary, q_dims int, lows binary"
        )
        dealt = blocks.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        return dealt.join(asked_blocks, "q_block")

    while True:
        counted = met(lows).mapInArrow(lambda b, w=width: _histograms(b, k, w), "query long, bin int, n long")
        counted = counted.groupBy("query", "bin").agg(F.sum("n").alias("n"))
        higher = Window.partitionBy("query").orderBy(F.desc("bin"))
        # at most BINS + 1 rows a query; the bin that holds the k-th highest is the first that brings the count to k
        chosen = counted.withColumn("upto", F.sum("n").over(higher)).where(F.col("upto") >= k)
        chosen = chosen.groupBy("query").agg(F.max("bin").alias("bin"))
        lows = materialize(
            lows.join(chosen, "query", "left").select("query", F.coalesce(F.col("low") + F.col("bin") * F.lit(width), "low").alias("low")),
            "topk-ranges",
        )
        if width == 1:
            break
        width = -(-width // BINS)
    found = met(lows).mapInArrow(lambda b: _kept(b, k), "query long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
