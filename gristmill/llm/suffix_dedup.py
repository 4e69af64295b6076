"""Removal of repeated 100-byte strings, by sorting sampled suffixes.

Every string of LENGTH bytes names one place in it, the leftmost of its K-byte pieces
with the least hash.  Equal strings name equal pieces at equal offsets, so strings meet
where their pieces meet.  One text names about one place in 40 bytes; a place travels
with the bytes of all strings that name it, packed and compressed, to the bucket of its
piece.  A context that a task meets again is settled there: only its first place travels.

A bucket sorts the bytes from each place onward and those before it, read backward:
multikey quicksort to a shallow depth, then blind tries (``suffix_order``).  A string that
begins ``o`` bytes before its place equals another one when at least LENGTH - o bytes agree onward and o
bytes backward; in the sorted orders both are runs, so each offset is one grouping, and all but the
earliest of a group are repeats.  Strings of one place overlap, so its repeats cover one stretch.

Bytes, offsets and contexts are compared as they are; hashes only choose places and buckets.

Defined results: texts are UTF-8 bytes, null is empty; texts shorter than LENGTH
lose nothing; earlier is a smaller id (as a long, null first), then a smaller hash of the text, then an earlier start;
rows with one id and one text are one document; an empty table gives no row; extra
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import broadcast_below, chunks, mix, pick, raw_bytes
from gristmill.llm.suffix_order import deep_shallow
from gristmill.llm.words import byte_values, powers
from gristmill.scratch import materialize

LENGTH, K = 100, 24
#: Pieces to a string; widths of the sorted sides, in whole words.
PIECES = LENGTH - K + 1
ONWARD, BACKWARD = -(-LENGTH // 8) * 8, -(-(PIECES - 1) // 8) * 8
#: Bytes of text hashed at once, bytes of text to a packed row, and bytes of contexts to a bucket.
CHUNK, FLUSH, BUCKET_BYTES = 1 << 20, 8 << 20, 16 << 20
#: Contexts take about so many times the bytes of the texts.
SPREAD = 3.6
BROADCAST_ROWS = 1_000_000
PLACE = np.dtype([("doc", "<i8"), ("tag", "<i4"), ("at", "<i4"), ("before", "u1"), ("onward", "u1")])
SPAN = np.dtype([("doc", "<i8"), ("tag", "<i4"), ("start", "<i4"), ("end", "<i4")])
SPANS = "doc long, tag int, start int, end int"


def places(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of every named place: number of the text, first and last start of the strings that name it, the place, hash of its piece."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    n = len(raw)
    if n < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    up, down = powers(n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte_values(raw) * up[:n], dtype=np.uint64)])
    pieces = mix((total[K:] - total[:-K]) * down[: n - K + 1])
    ranked = (pieces & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(pieces), dtype=np.uint64)
    # least of each PIECES neighbours: running minima of blocks from both sides
    padded = np.full(-(-len(ranked) // PIECES) * PIECES, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(ranked)] = ranked
    blocks = padded.reshape(-1, PIECES)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - LENGTH + 1)
    named = (np.minimum(backward[starts], forward[starts + PIECES - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.searchsorted(ends, starts, side="right")
    inside = starts + LENGTH <= ends[text]
    starts, named, text = starts[inside], named[inside], text[inside]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (np.diff(named) != 0) | (np.diff(text) != 0)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(starts)) - 1
    if not len(starts):
        first = last = np.zeros(0, np.int64)
    return text[first], starts[first], starts[last], named[first], pieces[named[first]]


def _packed(held: dict, buckets: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket of the contexts and settled spans that a flush holds."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for bucket, (rows, contexts, spans) in held.items():
        own = np.array(rows, PLACE)
        fields = b"".join(own[name].tobytes() for name in PLACE.names)
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([bucket], pa.int32()), "n": pa.array([len(rows)], pa.int32()),
            "places": pa.array([squeeze(fields)], pa.binary()), "contexts": pa.array([squeeze(b"".join(contexts))], pa.binary()),
            "spans": pa.array([squeeze(np.array(spans, SPAN).tobytes())], pa.binary()),
        })


def _offered(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc").to_pylist()
        tags = batch.column("tag").to_pylist()
        own = list(zip(ids, tags, raw_bytes(batch.column("text"))))
        sizes = np.cumsum([len(text) for _, _, text in own])
        cuts = [0, *np.flatnonzero(np.diff(sizes // FLUSH)) + 1, len(own)]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            rows = sorted({(doc, tag): text for doc, tag, text in own[begin:end] if len(text) >= LENGTH}.items())
            held: dict[int, tuple[list, list, list]] = {}
            first: dict[tuple[int, bytes], None] = {}
            done = 0
            for chunk in chunks((text for _, text in rows), CHUNK):
                raw = b"".join(chunk)
                begins = np.cumsum([0] + [len(text) for text in chunk])
                text, low, high, place, piece = places(chunk)
                bucket = (mix(piece ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).tolist()
                at = (place - begins[text]).tolist()
                for number, lo, hi, where, to, position in zip(text.tolist(), low.tolist(), high.tolist(), place.tolist(), bucket, at):
                    doc, tag = rows[done + number][0]
                    context = raw[lo : hi + LENGTH]
                    lists = held.setdefault(to, ([], [], []))
                    if (where - lo, context) in first:
                        lists[2].append((doc, tag, position - (where - lo), position - (where - hi) + LENGTH))
                    else:
                        first[where - lo, context] = None
                        lists[0].append((doc, tag, position, where - lo, hi + LENGTH - where))
                        lists[1].append(context)
                done += len(chunk)
            yield from _packed(held, buckets)


def _side(raw: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of ``width`` bytes from ``begin`` onward (or backward), zeros beyond ``size``."""
    column = np.arange(width)
    inside = column < size[:, None]
    at = np.where(inside, begin[:, None] + step * column, 0)
    return np.where(inside, raw[at], 0).astype(np.uint8)


def repeats(rows: np.ndarray, raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest offset of a repeated string at each place (-1: none); rows are in order of (doc, tag, at).

    ``begins`` says where each row's context begins in ``raw``.
    """
    n = len(rows)
    before, onward = rows["before"].astype(np.int64), rows["onward"].astype(np.int64)
    at = begins + before
    piece = np.ascontiguousarray(raw[at[:, None] + np.arange(K)]).view(np.uint64)
    order = np.lexsort(piece.T)
    new = np.ones(n, bool)
    new[1:] = (piece[order[1:]] != piece[order[:-1]]).any(axis=1)
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(new)
    least, most = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    if not several.size:
        return least, most
    at, before, onward, group = at[several], before[several], onward[several], group[several]
    m = len(several)
    sides = []
    for begin, size, width, step in ((at, onward, ONWARD, 1), (at - 1, before, BACKWARD, -1)):
        order, shared = deep_shallow(_side(raw, begin, size, width, step), group)
        place = np.empty(m, np.int64)
        place[order] = np.arange(m)
        sides.append((place, shared))
    for offset in range(PIECES):
        valid = np.flatnonzero((before >= offset) & (onward >= LENGTH - offset))
        if valid.size < 2:
            continue
        ahead, behind = (np.cumsum(shared < reach)[place[valid]] for (place, shared), reach in zip(sides, (LENGTH - offset, offset)))
        _, first = np.unique(ahead * (m + 1) + behind, return_index=True)
        again = np.ones(len(valid), bool)
        again[first] = False
        again = several[valid[again]]
        least[again[least[again] < 0]] = offset
        most[again] = offset
    return least, most


def _settled(key, table):
    """Spans of one bucket."""
    widen = zstandard.ZstdDecompressor().decompress
    rows, contexts, spans = [], [], []
    for n, fields, context, known in zip(*(table.column(c).to_pylist() for c in ("n", "places", "contexts", "spans"))):
        own, raw, done = np.empty(n, PLACE), widen(fields), 0
        for name in PLACE.names:
            size = PLACE[name].itemsize * n
            own[name] = np.frombuffer(raw[done : done + size], PLACE[name])
            done += size
        rows.append(own)
        contexts.append(widen(context))
        spans.append(np.frombuffer(widen(known), SPAN))
    rows, raw = np.concatenate(rows), np.frombuffer(b"".join(contexts), np.uint8)
    sizes = rows["before"].astype(np.int64) + rows["onward"]
    begins = np.cumsum(sizes) - sizes
    order = np.lexsort((rows["at"], rows["tag"], rows["doc"]))
    same = np.zeros(len(order), bool)
    same[1:] = (np.diff(rows["doc"][order]) == 0) & (np.diff(rows["tag"][order]) == 0) & (np.diff(rows["at"][order]) == 0)
    order = order[~same]
    rows, begins = rows[order], begins[order]
    least, most = repeats(rows, raw, begins)
    found = least >= 0
    out = np.empty(int(found.sum()), SPAN)
    out["doc"], out["tag"] = rows["doc"][found], rows["tag"][found]
    out["start"], out["end"] = rows["at"][found] - most[found], rows["at"][found] - least[found] + LENGTH
    out = np.concatenate([out, *spans])
    return pa.table({name: np.ascontiguousarray(out[name]) for name in SPAN.names})


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that the spans cover."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return starts[first], reach[np.append(first[1:], len(starts)) - 1]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [merged(np.array(s, np.int32), np.array(e, np.int32)) for s, e in zip(batch.column("starts").to_pylist(), batch.column("ends").to_pylist())]
        kind = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("tag"), pa.array([s.tolist() for s, _ in runs], kind), pa.array([e.tolist() for _, e in runs], kind)],
            names=["doc", "tag", "starts", "ends"],
        )


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    own = pick(docs, id_column, text_column)
    doc = F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63)))
    return own.select(F.col(id_column).alias("id"), doc.alias("doc"), F.hash(F.col(text_column)).alias("tag"), F.col(text_column).alias("text"))


def repeated_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc, tag, starts, ends): the maximal repeated runs of bytes of each document that has any."""
    own = _keyed(docs, id_column, text_column)
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size * SPREAD / BUCKET_BYTES))
    offered = own.select("doc", "tag", "text").mapInArrow(
        lambda b: _offered(b, buckets), "bucket int, n int, places binary, contexts binary, spans binary"
    )
    spans = offered.groupBy("bucket").applyInArrow(_settled, SPANS)
    gathered = spans.groupBy("doc", "tag").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    return materialize(gathered.mapInArrow(_runs, "doc long, tag int, starts array<int>, ends array<int>"), "repeated-runs")


def removal_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256."""
    runs = repeated_runs(docs, id_column, text_column)
    each = runs.select(F.explode("starts"))
    own = _keyed(docs, id_column, text_column).join(broadcast_below(runs, BROADCAST_ROWS, of=each), ["doc", "tag"], "left")

    @F.arrow_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, starts, ends in batches:
            rows = []
            for text, begin, end in zip(raw_bytes(texts), starts.to_pylist(), ends.to_pylist()):
                begin, end = begin or [], end or []
                kept = hashlib.sha256()
                for a, b in zip([0, *end], [*begin, len(text)]):
                    kept.update(text[a:b])
                rows.append((len(text), sum(end) - sum(begin), len(begin), kept.hexdigest()))
            kinds = [pa.int64()] * 3 + [pa.string()]
            columns = zip(*rows) if rows else ([], [], [], [])
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    return own.select(F.col("id").alias(id_column), cut("text", "starts", "ends").alias("c")).select(id_column, "c.*")
