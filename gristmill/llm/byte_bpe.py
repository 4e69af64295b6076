"""Byte-level BPE encoding and decoding.

Each match of the split pattern is encoded on its own.  The live pairs of a match
stand in a segment tree over its byte positions whose nodes hold the minimum pair
rank; the descent that prefers the left child finds the leftmost minimum, and a merge
is point updates at the live neighbours, so a match of n bytes costs O(n log n).
Short matches that a worker has not met yet are merged many at a time, one tree a row.

Defined results: a null text encodes like an empty one (no ids); bytes that are no
UTF-8 are read as U+FFFD; special tokens are ordinary text; text of any length is
encoded whole.  Equal rows give equal results, other columns are not looked at.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import chunks, pick, texts

NO_RANK = 1 << 62
#: Matches up to this many characters are remembered, and about so many of them per Python worker.
REMEMBERED_LENGTH, REMEMBERED = 48, 1 << 18
#: Matches of up to so many bytes are merged together, so many at once; texts are taken in chunks of so many characters.
LONGEST_ROW, AT_ONCE, CHUNK = 64, 1 << 14, 1 << 20

RESULT = "n_tokens long, ids binary, decoded binary"
DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file (one base64 token and its rank a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: merge the leftmost pair of lowest rank until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    tree = [NO_RANK] * (2 * size)
    token = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    for i in range(n - 1):
        tree[size + i] = ranks.get(token[i] + token[i + 1], NO_RANK)
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left <= right else right

    def put(position: int, rank: int) -> None:
        node = size + position
        tree[node] = rank
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            low = left if left <= right else right
            if tree[node] == low:
                break
            tree[node] = low

    def pair(position: int) -> int:
        right = after[position]
        return ranks.get(token[position] + token[right], NO_RANK) if right < n else NO_RANK

    while tree[1] < NO_RANK:
        node, low = 1, tree[1]
        while node < size:
            node *= 2
            if tree[node] != low:
                node += 1
        at = node - size
        gone = after[at]
        token[at] += token[gone]
        after[at] = after[gone]
        if after[at] < n:
            before[after[at]] = at
        put(gone, NO_RANK)
        put(at, pair(at))
        if before[at] >= 0:
            put(before[at], pair(before[at]))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[token[at]])
        at = after[at]
    return ids


class PairTable:
    """Rank of every pair of tokens that merges, as sorted arrays for lookups of many pairs at once."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int64)[order]
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == key), self.values[at], NO_RANK)


def merge_many(pieces: list[bytes], table: PairTable, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``merge_bytes`` for many matches of 2 to ``size`` bytes (a power of two): one segment tree a row, all rows in step.

    Gives the ids of all matches one after the other and how many each has.
    """
    n = len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, n)
    raw = np.frombuffer(b"".join([p.ljust(size, b"\0") for p in pieces]), np.uint8).reshape(n, size)
    column = np.arange(size)
    live = column < lengths[:, None]
    token = np.full((n, size + 1), -1, np.int64)  # the last column stands for "no neighbour"
    token[:, :size] = np.where(live, table.bytes[raw], -1)
    after = np.tile(np.arange(1, size + 2), (n, 1))
    before = np.tile(np.arange(-1, size), (n, 1))
    tree = np.full((n, 2 * size), NO_RANK, np.int64)
    tree[:, size : 2 * size - 1] = table.ranks(token[:, : size - 1], token[:, 1:size])
    for node in range(size - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
    levels = size.bit_length() - 1
    rows = np.flatnonzero(tree[:, 1] < NO_RANK)
    while rows.size:
        low = tree[rows, 1]
        node = np.ones(rows.size, np.int64)
        for _ in range(levels):
            node *= 2
            node += tree[rows, node] != low
        at = node - size
        gone = after[rows, at]
        token[rows, at] = low
        token[rows, gone] = -1
        live[rows, gone] = False
        new = np.minimum(after[rows, gone], size)
        after[rows, at] = new
        before[rows, new] = at
        left = before[rows, at]
        tree[rows, size + gone] = NO_RANK
        tree[rows, size + at] = table.ranks(low, token[rows, new])
        has = left >= 0
        tree[rows[has], size + left[has]] = table.ranks(token[rows[has], left[has]], low[has])
        for position in (gone, at, np.maximum(left, 0)):
            node = (size + position) >> 1
            for _ in range(levels):
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                node >>= 1
        rows = rows[tree[rows, 1] < NO_RANK]
    return token[:, :size][live].astype("<u4"), live.sum(axis=1)


class Codec:
    """Encoder and decoder of one rank file; lives in a Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.table, self.matches = ranks, PairTable(ranks), regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8")
            whole = self.ranks.get(raw)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            elif len(raw) > LONGEST_ROW:
                self.known[piece] = struct.pack(f"<{len(ids := merge_bytes(raw, self.ranks))}I", *ids)
            else:
                by_size.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for size, own in by_size.items():
            for start in range(0, len(own), AT_ONCE):
                part = own[start : start + AT_ONCE]
                ids, counts = merge_many([raw for _, raw in part], self.table, size)
                packed, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
                for (piece, _), begin, end in zip(part, [0, *ends], ends):
                    self.known[piece] = packed[begin:end]

    def encode_all(self, chunk: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.matches(text) for text in chunk]
        pieces = set().union(*split)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self._learn(pieces.difference(self.known))
        packed = [b"".join(map(self.known.__getitem__, own)) for own in split]
        for piece in pieces:
            if len(piece) > REMEMBERED_LENGTH:
                del self.known[piece]
        return packed

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, struct.unpack(f"<{len(packed) // 4}I", packed)))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec a worker and rank file; the file is read where the task runs."""
    return Codec(read_ranks(path), pattern)


def _column(text: Column, path: str, pattern: str, schema: str, finish) -> Column:
    @F.arrow_udf(schema)
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path, pattern)
        for values in batches:
            counts, ids, decoded = [], [], []
            for chunk in chunks(texts(values), CHUNK):
                for packed in own.encode_all(chunk):
                    counts.append(len(packed) // 4)
                    ids.append(finish(packed))
                    decoded.append(finish(own.decode(packed)))
            kind = pa.string() if schema == DIGEST else pa.binary()
            names = [part.split()[0] for part in schema.split(", ")]
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(ids, kind), pa.array(decoded, kind)], names=names)

    return encoded(text)


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def encode(text: Column, path: str, pattern: str) -> Column:
    """Struct column (n_tokens, ids, decoded): ids as little-endian unsigned 32-bit integers, and the bytes they decode to."""
    return _column(text, path, pattern, RESULT, bytes)


def token_digests(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256; the ids themselves stay in the task."""
    own = pick(docs, id_column, text_column)
    coded = _column(F.col(text_column), path, pattern, DIGEST, _hex)
    return own.select(id_column, coded.alias("coded")).select(id_column, "coded.*")
