"""Packing of documents into token sequences of a fixed size by sums of squares.

Every document is its ids and an end mark, cut into pieces only where it is longer than
a sequence.  Whole-sequence pieces stand alone.  The others are dealt out evenly over
groups by a number of their own, so neither a hot document nor a hot source makes a
group large, and each group places its pieces: a piece goes where the sum over residual
gaps of the squared number of open sequences with that gap becomes smallest.  A group
does so twice, longest first with new sequences only where nothing fits, and in random
order with a new sequence as one of the choices, and keeps what takes fewer.  What the
groups leave in badly filled sequences is packed once more among all groups.

Defined results: a null text is an empty one, and an empty one is its end mark alone;
equal rows are documents of their own; an empty table gives no pieces; texts of any
length are encoded whole; columns beside id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import chunks, mix, pick, texts
from gristmill.llm.piecewise import words
from gristmill.scratch import materialize

SEQUENCE, END_MARK = 4096, 1
#: Pieces a group packs; sequences filled below this share are packed again across groups.
GROUP, FILLED = 1 << 14, 0.98
#: Characters encoded at once.
CHUNK = 1 << 20


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_mark: int = END_MARK, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, a number of its own and, if asked for, the ids."""
    own = pick(docs, "doc_id", "text")
    id_type = own.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, number long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = words(tokenizer), TaskContext.get().partitionId() << 33
        mark = np.array([end_mark], "<u4").tobytes()
        for batch in batches:
            at, out = 0, {name: [] for name in ("row", "piece", "start", "length", "crc", "ids")}
            for part in chunks(texts(batch.column(1)), CHUNK):
                for ids in encoder.ids(part):
                    raw = ids.tobytes() + mark
                    for piece, start in enumerate(range(0, len(raw), 4 * size)):
                        own_ids = raw[start : start + 4 * size]
                        for name, value in zip(out, (at, piece, start // 4, len(own_ids) // 4, zlib.crc32(own_ids), own_ids if with_ids else None)):
                            out[name].append(value)
                    at += 1
            rows = len(out["row"])
            columns = [
                batch.column(0).take(pa.array(out["row"], pa.int64())), pa.array(np.arange(number, number + rows)), pa.array(out["piece"], pa.int32()),
                pa.array(out["start"], pa.int64()), pa.array(out["length"], pa.int64()), pa.array(out["crc"], pa.int64()),
            ] + ([pa.array(out["ids"], pa.binary())] if with_ids else [])
            number += rows
            yield pa.RecordBatch.from_arrays(columns, [c.strip().split(" ")[0] for c in schema.split(",")])

    return own.mapInArrow(cut, schema)


def place(lengths: np.ndarray, size: int, open_first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, taken in the given order.

    With ``open_first`` a new sequence is no choice as long as a piece fits into an open one.  Of equal choices the
    smallest gap is taken, a new sequence last.
    """
    open_with = np.zeros(size + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    sequence, offset, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, length in enumerate(lengths.tolist()):
        # growth of the sum of squares: a gap loses one, the gap it leaves gains one, an exactly filled one leaves none
        have = open_with[length:size]
        growth = 2 * (open_with[: size - length] - have) + 2
        growth[:1] -= 1
        growth[have == 0] = np.iinfo(np.int64).max
        gap = length + int(growth.argmin()) if len(have) else size
        new = 2 * int(open_with[size - length]) + 1 if length < size else 0
        if gap < size and open_with[gap] and (open_first or growth[gap - length] <= new):
            open_with[gap] -= 1
            into = by_gap[gap].pop()
        else:
            gap, into, used = size, used, used + 1
        sequence[i], offset[i] = into, size - gap
        if gap > length:
            open_with[gap - length] += 1
            by_gap[gap - length].append(into)
    return sequence, offset


def _pack_groups(rows: DataFrame, group, size: int) -> DataFrame:
    """Pack the rows of each group; adds sequence_id, offset and how much of the sequence is filled."""
    plain = rows.drop("group", "sequence_id", "offset", "filled").withColumn("group", group)

    def pack(table: pa.Table) -> pa.Table:
        lengths, numbers = table["length"].to_numpy(), table["number"].to_numpy()
        ways = []
        for order, open_first in ((np.lexsort((numbers, -lengths)), True), (np.argsort(mix(numbers.astype(np.uint64))), False)):
            ways.append((order, *place(lengths[order], size, open_first)))
        order, sequence, offset = min(ways, key=lambda way: way[1].max())
        filled = np.bincount(sequence, lengths[order]).astype(np.int64)[sequence]
        table = table.take(pa.array(order))
        for name, values in (("sequence_id", table["group"].to_numpy() * (1 << 32) + sequence), ("offset", offset), ("filled", filled)):
            table = table.append_column(name, pa.array(values))
        return table

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields) + ", sequence_id long, offset long, filled long"
    return plain.groupBy("group").applyInArrow(pack, schema)


def packed(written: DataFrame, size: int = SEQUENCE, group_size: int = GROUP) -> DataFrame:
    """The written pieces with ``sequence_id`` and ``offset``: gapless from 0 in every sequence, at most ``size`` tokens each."""
    alone, rest = written.where(F.col("length") >= size), written.where(F.col("length") < size)
    deal = lambda n: F.pmod(F.xxhash64("number"), F.lit(n))
    groups = max(1, -(-rest.count() // group_size))
    done = materialize(_pack_groups(rest, deal(groups), size), "packed")
    if groups > 1:
        loose = done.where(F.col("filled") < int(FILLED * size))
        again = max(1, -(-loose.count() // group_size))
        # groups of the second packing have numbers below zero
        done = done.where(F.col("filled") >= int(FILLED * size)).unionByName(_pack_groups(loose, -1 - deal(again), size))
    stands = alone.withColumns({"sequence_id": F.col("number") + (1 << 62), "offset": F.lit(0).cast("long")})
    return done.drop("group", "filled").unionByName(stands)


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """The token sequences themselves, for pieces that carry their ids: sequence_id, doc_ids, ids (unsigned 32-bit, little endian)."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = F.aggregate("inside", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    rows = packed_pieces.groupBy("sequence_id").agg(inside.alias("inside"))
    return rows.select("sequence_id", F.col("inside.doc_id").alias("doc_ids"), joined.alias("ids"))
