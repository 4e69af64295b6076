"""Alignment of the tokens that two tokenizers make of the same texts.

A worker encodes a chunk of texts with both tokenizers and merges the token ends of the
whole chunk by merge paths (``merge_path``), so a very long text is no more work for one
piece than many short ones.  Overlaps come out, groups of tokens between common ends,
and links: tokens of both sides that end together.

How often a pair of ids is linked in the whole corpus is counted from the distinct pairs
of each chunk.  The counts go back to the chunks that hold the pair, one row a chunk and
pair, and there to the documents, so no row per link is ever shuffled, no table is
broadcast, and a pair that every text holds is one row a chunk.

Defined results: a text that is null or empty, or one of whose sides does not give back
the blank and the text, has no tokens: zeros and an empty digest.  Equal rows are
documents of their own and all count.  An empty table gives no rows; texts of any length
are aligned whole; columns beside id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gristmill.llm import merge_path
from gristmill.llm.common import chunks, pick, texts
from gristmill.llm.piecewise import byte_level, sentence_pieces
from gristmill.scratch import materialize

#: Characters that are encoded and merged at once, and so much of them shares one list of id pairs.
CHUNK = 1 << 20


class Sides(NamedTuple):
    """Ids and token ends of all aligned texts of a chunk, one after the other, and where each text's tokens begin."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    from_a: np.ndarray
    from_b: np.ndarray


def _joined(encoder, tokens: list[bytes], sizes: np.ndarray, wanted: list[bytes], whole: list[str]) -> list[np.ndarray | None]:
    """Ids of each text, or None where their bytes are not the text's."""
    out = []
    for ids, want in zip(encoder.ids(whole), wanted):
        same = int(sizes[ids].sum()) == len(want) and b"".join([tokens[i] for i in ids.tolist()]) == want
        out.append(ids if same else None)
    return out


def encode_sides(part: list[str], path_a: str, path_b: str) -> Sides:
    """Both tokenizers over a blank and the text, for each text of a chunk; a text that cannot be aligned has no tokens."""
    (coder_a, tokens_a), (coder_b, tokens_b) = byte_level(path_a), sentence_pieces(path_b)
    size_a, size_b = (np.array([len(t) for t in tokens], np.int64) for tokens in (tokens_a, tokens_b))
    whole = [" " + text for text in part if text]
    wanted = [text.encode() for text in whole]
    found_a = _joined(coder_a, tokens_a, size_a, wanted, whole)
    found_b = _joined(coder_b, tokens_b, size_b, wanted, whole)
    none, at = np.zeros(0, "<u4"), 0
    own_a, own_b = [], []
    for text in part:
        both = (found_a[at], found_b[at]) if text else (None, None)
        at += bool(text)
        aligned = both[0] is not None and both[1] is not None
        own_a.append(both[0] if aligned else none)
        own_b.append(both[1] if aligned else none)
    starts = lambda own: np.cumsum([0] + [len(x) for x in own])
    ids_a, ids_b = np.concatenate([none, *own_a]), np.concatenate([none, *own_b])
    return Sides(ids_a, ids_b, np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b]), starts(own_a), starts(own_b))


OVERLAP = "array<struct<a int, b int, start long, end long, ends_both boolean, group int>>"


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: ids of both sides and all overlaps (token numbers, shared bytes of blank and text, group), in order."""
    own = pick(docs, "doc_id", "text")
    schema = f"doc_id {own.schema['doc_id'].dataType.simpleString()}, a_ids array<int>, b_ids array<int>, overlaps {OVERLAP}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in chunks(texts(batch.column(1)), CHUNK):
                sides = encode_sides(part, path_a, path_b)
                over = merge_path.overlaps(sides.ends_a, sides.ends_b)
                cuts = np.searchsorted(over.a, sides.from_a)
                text_of = np.repeat(np.arange(len(part)), np.diff(cuts))
                first_group = np.append(over.group, 0)[np.minimum(cuts[:-1], max(0, len(over.group)))]
                base = np.append(0, sides.ends_a)[sides.from_a]
                fields = {
                    "a": pa.array((over.a - sides.from_a[text_of]).astype(np.int32)), "b": pa.array((over.b - sides.from_b[text_of]).astype(np.int32)),
                    "start": pa.array(over.start - base[text_of]), "end": pa.array(over.end - base[text_of]), "ends_both": pa.array(over.ends_both),
                    "group": pa.array((over.group - first_group[text_of]).astype(np.int32)),
                }
                nested = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.StructArray.from_arrays(list(fields.values()), list(fields)))
                lists = [
                    pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32)))
                    for starts, ids in ((sides.from_a, sides.ids_a), (sides.from_b, sides.ids_b))
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), *lists, nested], ["doc_id", "a_ids", "b_ids", "overlaps"])
                at += len(part)

    return own.mapInArrow(work, schema)


def _decimal(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of all numbers below ``most``, a byte for the mark behind them, and how many bytes that is."""
    digits = np.zeros((most, len(str(most)) + 1), np.uint8)
    sizes = np.zeros(most, np.int64)
    for n in range(most):
        own = str(n).encode()
        digits[n, : len(own)] = np.frombuffer(own, np.uint8)
        sizes[n] = len(own)
    return digits, sizes


_tables: list = []


def group_texts(sides: Sides, over: merge_path.Overlaps) -> list[bytes]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3`` in decimal ids; no bytes for a text without tokens."""
    if not _tables:
        _tables.extend(_decimal(1 << 17))
    digits, sizes = _tables
    n_a, n_b = len(sides.ids_a), len(sides.ids_b)
    # a token's group is that of its last overlap
    group_a, group_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    group_a[over.a], group_b[over.b] = over.group, over.group
    ids = np.concatenate([sides.ids_a, sides.ids_b]).astype(np.int64)
    group = np.concatenate([group_a, group_b])
    side = np.repeat(np.array([0, 1], np.int8), [n_a, n_b])
    order = np.argsort(2 * group + side, kind="stable")
    ids, group, side = ids[order], group[order], side[order]
    mark = np.full(len(ids), ord(","), np.uint8)
    last = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True) if len(ids) else np.zeros(0, bool)
    mark[last & (side == 0)], mark[last & (side == 1)] = ord("|"), ord(";")
    rows, length = digits[ids], sizes[ids]
    rows[np.arange(len(ids)), length] = mark
    raw = rows[np.arange(rows.shape[1]) <= length[:, None]].tobytes()
    tokens = np.concatenate([[0], np.cumsum(length + 1)])
    # the tokens of one text stand together, as groups never reach over texts; the mark behind the last is left out
    cuts = tokens[sides.from_a + sides.from_b].tolist()
    return [raw[a : max(a, b - 1)] for a, b in zip(cuts[:-1], cuts[1:])]


#: What a chunk gives: a row per document, with its links as numbers in the chunk's list of id pairs, and a row per pair of that list.
PER_DOCUMENT = "at int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
PER_PAIR = "number int, a int, b int, times int"


def _bytes_apart(numbers: np.ndarray) -> bytes:
    """32-bit numbers with their first, second, third and fourth bytes together, which compresses well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _together(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _chunk_rows(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    own = pick(docs, "doc_id", "text")
    schema = f"doc_id {own.schema['doc_id'].dataType.simpleString()}, chunk long, {PER_DOCUMENT}, {PER_PAIR}"
    types = to_arrow_schema(StructType.fromDDL(schema))

    def rows(count: int, values: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(values[f.name], f.type) if f.name in values else pa.nulls(count, f.type) for f in types], schema=types
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            begin = 0
            for part in chunks(texts(batch.column(1)), CHUNK):
                sides = encode_sides(part, path_a, path_b)
                over = merge_path.overlaps(sides.ends_a, sides.ends_b)
                digest = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(sides, over)]
                end_a, end_b = over.a[over.ends_both], over.b[over.ends_both]
                pair = (sides.ids_a[end_a].astype(np.int64) << 32) | sides.ids_b[end_b].astype(np.int64)
                distinct, number, times = np.unique(pair, return_inverse=True, return_counts=True)
                cuts = np.searchsorted(end_a, sides.from_a)
                n, links = len(part), np.diff(cuts)
                yield rows(n, {
                    "doc_id": batch.column(0).slice(begin, n).to_pylist(), "chunk": np.full(n, chunk), "at": np.arange(n, dtype=np.int32),
                    "n_a": np.diff(sides.from_a), "n_b": np.diff(sides.from_b), "n_groups": links, "n_links": links, "groups_sha256": digest,
                    "links": [_bytes_apart(number[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())],
                })
                yield rows(len(distinct), {
                    "chunk": np.full(len(distinct), chunk), "number": np.arange(len(distinct), dtype=np.int32), "a": (distinct >> 32).astype(np.int32),
                    "b": (distinct & 0xFFFFFFFF).astype(np.int32), "times": times.astype(np.int32),
                })
                chunk, begin = chunk + 1, begin + n

    return own.mapInArrow(work, schema)


def link_counts(pairs: DataFrame) -> DataFrame:
    """Each pair's links in the whole corpus and whether no other pair of its ``b`` has more."""
    counts = materialize(pairs.groupBy("a", "b").agg(F.sum("times").alias("count")), "link-counts")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))


def linked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: tokens of both sides, groups and their digest, links, those with the corpus's favourite of their b, and the sum of counts."""
    written = materialize(_chunk_rows(docs, path_a, path_b), "aligned-chunks")
    pairs = written.where(F.col("number").isNotNull()).select("chunk", "number", "a", "b", "times")
    known = pairs.join(link_counts(pairs), ["a", "b"]).select(F.col("chunk").alias("of_chunk"), "number", "count", "best")
    own = written.where(F.col("number").isNull()).drop("number", "a", "b", "times")
    kept = [f for f in own.schema.fields if f.name not in ("chunk", "at", "links")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", n_best long, count_sum long"

    def add_up(rows: pa.Table, list_of_chunk: pa.Table) -> pa.Table:
        count, best = np.zeros(len(list_of_chunk), np.int64), np.zeros(len(list_of_chunk), np.int64)
        number = list_of_chunk["number"].to_numpy()
        count[number], best[number] = list_of_chunk["count"].to_numpy(), list_of_chunk["best"].to_numpy(zero_copy_only=False)
        links = [_together(raw.as_py()) for raw in rows["links"]]
        out = rows.select([f.name for f in kept])
        for name, values in (("n_best", best), ("count_sum", count)):
            out = out.append_column(name, pa.array([int(values[own].sum()) for own in links], pa.int64()))
        return out

    return own.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(add_up, schema)
