"""Which tokens do several ids share: tokens travel packed, and only shared ones become rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from gristmill.llm.common import mix

#: Tokens are numbers of so many bits; a bucket is meant to hold about so many of them.
TOKEN_BITS, BUCKET_TOKENS = 40, 1_000_000
#: A token that so many ids of one task's chunk have is known to be shared: all but two of its ids take one of SPREAD more buckets a bucket.
HEAVY, SPREAD = 64, 16
PACKED = "bucket int, tokens binary, own binary, place binary, ids binary, sizes binary"
SHARED = "token long, id long, size long, place long"

_BYTES = TOKEN_BITS // 8


def spread(tokens: np.ndarray, own: np.ndarray, place: np.ndarray, ids: list, sizes: list, buckets: int) -> Iterator[pa.RecordBatch]:
    """``packed``, but hot tokens do not gather in one bucket: ``known_tokens`` reads the rows.

    Where HEAVY ids of this chunk have a token it needs no other task to know that it is shared.  Two of them go the usual
    way, so an id elsewhere that meets no more than these stays; the others go to further buckets, chosen by the chunk.
    """
    order = np.argsort(tokens, kind="stable")
    tokens, own, place = tokens[order], own[order], place[order]
    begin = np.flatnonzero(np.diff(tokens, prepend=~tokens[:1]))
    counts = np.diff(np.append(begin, len(tokens)))
    rank = np.arange(len(tokens)) - np.repeat(begin, counts)
    far = (rank >= 2) & np.repeat(counts >= HEAVY, counts)
    yield from packed(tokens[~far], own[~far], place[~far], ids, sizes, buckets)
    chosen = int(mix(np.array(ids[:1], np.int64).view(np.uint64))[0]) % SPREAD if len(ids) else 0
    for row in packed(tokens[far], own[far], place[far], ids, sizes, buckets):
        yield row.set_column(0, "bucket", pa.array([buckets * (1 + chosen) + row.column("bucket")[0].as_py()], pa.int32()))


def known_tokens(key, table, buckets: int):
    """Tokens of a bucket of ``spread`` that several ids have, one row each token and id; beyond ``buckets`` all have."""
    return shared_tokens(key, table, 1 if key[0].as_py() >= buckets else 2)


def packed(tokens: np.ndarray, own: np.ndarray, place: np.ndarray, ids: list, sizes: list, buckets: int, marks: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """One row per bucket (a range of tokens): sorted tokens, the ids they belong to (``own`` numbers them), sizes, places, and 64 bits more a token if there are ``marks``.

    Differences of sorted tokens are written byte by byte, equal bytes together, which compresses well.
    """
    order = np.argsort(tokens, kind="stable")
    tokens, own, place = tokens[order], own[order], place[order]
    marks = None if marks is None else marks[order]
    cuts = np.searchsorted(tokens, np.array([b * (1 << TOKEN_BITS) // buckets for b in range(buckets + 1)], np.uint64))
    for bucket, (begin, end) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if begin == end:
            continue
        used, renamed = np.unique(own[begin:end], return_inverse=True)
        steps = np.diff(tokens[begin:end], prepend=np.uint64(0))
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([bucket], pa.int32()),
            "tokens": pa.array([steps.view(np.uint8).reshape(-1, 8).T[:_BYTES].tobytes()], pa.binary()),
            "own": pa.array([renamed.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32).tobytes()], pa.binary()),
            "place": pa.array([place[begin:end].astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()], pa.binary()),
            "ids": pa.array([np.array(ids, np.int64)[used].tobytes()], pa.binary()),
            "sizes": pa.array([np.array(sizes, np.int64)[used].tobytes()], pa.binary()),
            **({} if marks is None else {"marks": pa.array([marks[begin:end].tobytes()], pa.binary())}),
        })


def unpacked(row: dict) -> tuple[np.ndarray, ...]:
    """Sorted tokens of a row of ``packed``, and the id, size and place of each."""
    steps = np.frombuffer(row["tokens"], np.uint8).reshape(_BYTES, -1).T
    full = np.zeros((len(steps), 8), np.uint8)
    full[:, :_BYTES] = steps
    tokens = np.cumsum(full.view(np.uint64).ravel(), dtype=np.uint64).view(np.int64)
    own = np.frombuffer(row["own"], np.uint16 if 2 * len(steps) == len(row["own"]) else np.uint32)
    place = np.frombuffer(row["place"], np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel().astype(np.int64)
    return tokens, np.frombuffer(row["ids"], np.int64)[own], np.frombuffer(row["sizes"], np.int64)[own], place


def shared_tokens(key, table, several: int = 2):
    """Tokens of a bucket that ``several`` ids have: one row each token and id."""
    tokens, ids, sizes, place = (np.concatenate(parts) for parts in zip(*map(unpacked, table.to_pylist())))
    order = np.argsort(tokens, kind="stable")
    if several > 1:
        # most tokens are alone in the corpus: drop them before the full sort
        same = np.diff(tokens[order]) == 0
        stays = np.zeros(len(order), bool)
        stays[1:] |= same
        stays[:-1] |= same
        order = order[stays]
    order = order[np.lexsort((ids[order], tokens[order]))]
    tokens, ids, sizes, place = tokens[order], ids[order], sizes[order], place[order]
    first = np.ones(len(tokens), bool)
    first[1:] = (np.diff(tokens) != 0) | (np.diff(ids) != 0)
    tokens, ids, sizes, place = tokens[first], ids[first], sizes[first], place[first]
    _, at, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    keep = counts[at] >= several
    return pa.table({"token": tokens[keep], "id": ids[keep], "size": sizes[keep], "place": place[keep]})
