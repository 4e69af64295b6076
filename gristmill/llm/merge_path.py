"""Merging of two sorted lists of token ends in independent pieces of equal work.

The merge of two lists is a staircase path through the grid of their positions.  A
binary search on a diagonal of the grid finds the point where the path crosses it, so
diagonals at even distances cut the path into pieces of the same number of steps,
whatever texts they fall into.  All pieces walk at once, one array operation a step.  A
step takes the smaller end (that of A where both are equal) and emits the overlap of the
two tokens it stands on.  A piece that begins inside a group has its first overlaps
stitched to the group that the piece before left open.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Steps a piece walks.
STEPS = 64


class Overlaps(NamedTuple):
    """Pairs of tokens that share bytes, in order: their numbers, the shared bytes, whether both end there, and their group."""

    a: np.ndarray
    b: np.ndarray
    start: np.ndarray
    end: np.ndarray
    ends_both: np.ndarray
    group: np.ndarray


def crossings(ends_a: np.ndarray, ends_b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many tokens of A the merge has taken after ``diagonals`` steps: one binary search a diagonal, all at once."""
    low = np.maximum(0, diagonals - len(ends_b))
    high = np.minimum(diagonals, len(ends_a))
    while (low < high).any():
        middle = (low + high) // 2
        other = diagonals - 1 - middle
        # is A's token number ``middle`` among those already taken?
        taken = (low < high) & (ends_a[np.minimum(middle, len(ends_a) - 1)] <= ends_b[np.clip(other, 0, len(ends_b) - 1)])
        low = np.where(taken, middle + 1, low)
        high = np.where(taken | (low >= high), high, middle)
    return low


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, steps: int = STEPS) -> Overlaps:
    """All overlaps of two lists of non-empty tokens over the same bytes, given by their rising ends."""
    total = len(ends_a) + len(ends_b)
    if not total:
        return Overlaps(*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, bool), np.zeros(0, np.int64))
    begins = np.arange(0, total, steps, dtype=np.int64)
    i = crossings(ends_a, ends_b, begins)
    j = begins - i
    beyond = max(int(ends_a[-1]), int(ends_b[-1])) + 1
    a, b = np.append(ends_a, beyond), np.append(ends_b, beyond)
    # the byte up to which the pieces before have come
    last = np.maximum(np.where(i > 0, a[i - 1], 0), np.where(j > 0, b[j - 1], 0))
    shape = (len(begins), steps)
    at_a, at_b, start, end = (np.zeros(shape, np.int64) for _ in range(4))
    both = np.zeros(shape, bool)
    for step in range(steps):
        end_a, end_b = a[i], b[j]
        from_a = end_a <= end_b
        reached = np.where(from_a, end_a, end_b)
        at_a[:, step], at_b[:, step], start[:, step], end[:, step] = i, j, last, reached
        both[:, step] = end_a == end_b
        i = np.minimum(i + from_a, len(ends_a))
        j = np.minimum(j + ~from_a, len(ends_b))
        last = reached
    # a step without bytes is the second of two equal ends, or lies behind the end of both lists
    real = ((start < end) & (end < beyond)).ravel()
    at_a, at_b, start, end, both = (x.ravel()[real] for x in (at_a, at_b, start, end, both))
    piece = np.repeat(np.arange(len(begins)), steps)[real]
    return Overlaps(at_a, at_b, start, end, both, _stitched(both, piece, len(begins)))


def _stitched(ends_both: np.ndarray, piece: np.ndarray, pieces: int) -> np.ndarray:
    """Group number of each overlap: each piece counts its own closed groups, and a sum over pieces tells where it begins."""
    closed = np.bincount(piece, ends_both, minlength=pieces).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(closed)[:-1]])
    running = np.cumsum(ends_both)
    first = np.searchsorted(piece, np.arange(pieces))
    inside = running - ends_both - np.concatenate([[0], running])[np.minimum(first, len(running))][piece]
    return before[piece] + inside
