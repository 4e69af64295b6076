"""Hashed words and shingles of many texts at once, in arrays."""

from __future__ import annotations

import numpy as np

from gristmill.llm.common import mix

_rng = np.random.default_rng(20240229)
#: A random 64-bit value per byte, an odd base and its inverse modulo 2**64.
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 40, 1 << 62)) * 8 + 5
_BACK = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse; kept and doubled as longer texts come."""
    while len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BACK)):
            step = np.uint64(pow(base, len(_powers[i]), 1 << 64))
            _powers[i] = np.concatenate([_powers[i], _powers[i] * step])
    return _powers[0][:n], _powers[1][:n]


def byte_values(raw: np.ndarray) -> np.ndarray:
    """The random value of each byte."""
    return _BYTE[raw]


def spans_of_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words in lower-cased bytes, and where each begins and ends.

    A word is a longest run without the bytes 32 and 9 to 13.  A word's hash is a polynomial in random byte values,
    cut out of one running sum, and mixed.
    """
    inside = ~_IS_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    up, down = powers(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=np.uint64)])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def lowered(texts: list[bytes]) -> np.ndarray:
    """Bytes of all texts with A-Z in lower case, a blank after each."""
    return _LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin (one more than texts)."""
    hashes, starts, _ = spans_of_words(lowered(texts))
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(starts, begins)


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of ``width`` words of each text; a shorter text is one run, an empty one none."""
    words, begins = hashed_words(texts)
    runs = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(runs)]
    runs = mix(runs)
    sets = []
    for begin, end in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if end - begin >= width:
            sets.append(np.unique(runs[begin : end - width + 1]))
        elif end > begin:
            short = np.zeros(1, np.uint64)
            for word in words[begin:end]:
                short = short * np.uint64(0xD1342543DE82EF95) + word
            sets.append(mix(short + np.uint64(end - begin)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
