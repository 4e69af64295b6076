"""Minimised acceptors over arrays, and their composition with a one-edit transducer.

Words are rows of codes.  The acceptor's states are the classes of their suffix sets, found
from the ends of the words upwards, height by height, so equal suffix sets are one state
wherever they stand.  Every state knows how many words lie before each of its arcs, so a
path through the acceptor tells the number of its word.

A state of the composition is a pair of acceptor states with no edit made (both equal) or
one edit made.  Pairs without an edit walk down the acceptor; at each of them the
transducer replaces one code by another or drops one, always at the first place where
the two words differ, so each pair of words is met once.  After the edit both sides read
the same codes.  Whole fronts of composed states advance at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Composed states that advance together.
FRONT = 1 << 19


class Acceptor(NamedTuple):
    """Arcs of state s are rows ``first[s]:first[s + 1]``, sorted by code; ``before`` counts the state's words ahead of an arc's."""

    first: np.ndarray
    code: np.ndarray
    target: np.ndarray
    before: np.ndarray
    final: np.ndarray
    lengths: np.ndarray
    start: int
    base: int


def _classes(columns: list[np.ndarray]) -> np.ndarray:
    """Number of the class of equal rows that each row belongs to."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    for column in columns:
        sorted_column = column[order]
        new[1:] |= sorted_column[1:] != sorted_column[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def minimised(codes: np.ndarray, sizes: np.ndarray) -> Acceptor:
    """The acceptor of distinct words in rising order; ``codes`` is padded with zeros, codes are above zero."""
    n, width = codes.shape
    # a trie node is a prefix; the word that shows it first owns it
    differs = np.ones((n, width), bool)
    if n > 1:
        differs[1:] = np.logical_or.accumulate(codes[1:] != codes[:-1], axis=1)
    inside = np.arange(width) < sizes[:, None]
    owner, depth = np.nonzero(differs & inside)
    root = len(owner)
    number = np.full((n, width + 1), root, np.int64)
    number[owner, depth + 1] = np.arange(root)
    # prefixes that another word owns: the last owner above
    for d in range(1, width + 1):
        own = np.where(number[:, d] < root, np.arange(n), 0)
        known = np.maximum.accumulate(own)
        number[:, d] = number[known, d]
    parent, code = number[owner, depth], codes[owner, depth].astype(np.int64)
    final = np.zeros(root + 1, np.int64)
    final[number[np.arange(n), sizes]] = 1
    height, words = np.zeros(root + 1, np.int64), final.copy()
    lengths = final.astype(np.uint64)
    for d in range(width - 1, -1, -1):
        here = np.flatnonzero(depth == d)
        np.maximum.at(height, parent[here], height[here] + 1)
        np.add.at(words, parent[here], words[here])
        # lengths of what may follow; bit 63 stands for all from 63 on
        longer = (lengths[here] << np.uint64(1)) | (lengths[here] & np.uint64(1 << 63))
        np.bitwise_or.at(lengths, parent[here], longer)
    by_parent = np.lexsort((code, parent))
    child_first = np.searchsorted(parent[by_parent], np.arange(root + 2))
    state = np.full(root + 1, -1, np.int64)
    shown: list[np.ndarray] = []
    states = 0
    for h in range(int(height.max(initial=0)) + 1):
        nodes = np.flatnonzero(height == h)
        kind = final[nodes]
        degree = child_first[nodes + 1] - child_first[nodes]
        for k in range(int(degree.max(initial=0))):
            has = degree > k
            arc = by_parent[np.where(has, child_first[nodes] + k, 0)] if root else np.zeros(len(nodes), np.int64)
            kind = _classes([kind, np.where(has, code[arc], 0), np.where(has, state[arc], -1)])
        kind = _classes([kind, degree])
        _, example, of = np.unique(kind, return_index=True, return_inverse=True)
        state[nodes] = states + of
        shown.append(nodes[example])
        states += len(example)
    example = np.concatenate(shown)
    degree = child_first[example + 1] - child_first[example]
    first = np.concatenate([[0], np.cumsum(degree)])
    arc = by_parent[np.repeat(child_first[example], degree) + np.arange(first[-1]) - np.repeat(first[:-1], degree)] if root else np.zeros(0, np.int64)
    ahead = np.cumsum(words[arc]) - words[arc]
    starts = np.minimum(first[:-1], max(0, len(arc) - 1))
    base = ahead[starts] if len(arc) else np.zeros(states, np.int64)
    before = ahead - np.repeat(base, degree) + np.repeat(final[example], degree)
    return Acceptor(first, code[arc], state[arc], before, final[example].astype(bool), lengths[example], int(state[root]), int(code.max(initial=0)) + 1)


def _spread(first: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All arcs of the given states: which of the states, and the arc."""
    degree = first[states + 1] - first[states]
    of = np.repeat(np.arange(len(states)), degree)
    return of, np.repeat(first[states], degree) + np.arange(len(of)) - np.repeat(np.cumsum(degree) - degree, degree)


def _slices(*front: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    for i in range(0, len(front[0]), FRONT):
        yield tuple(x[i : i + FRONT] for x in front)


def same_rest(auto: Acceptor, p: np.ndarray, q: np.ndarray, word_p: np.ndarray, word_q: np.ndarray, not_code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of words that states p and q both complete by the same codes; q does not begin with ``not_code`` (0 forbids none)."""
    keys = np.repeat(np.arange(len(auto.final)), np.diff(auto.first)) * auto.base + auto.code
    todo = [front for front in _slices(p, q, word_p, word_q, not_code)]
    while todo:
        p, q, word_p, word_q, not_code = todo.pop()
        able = (auto.lengths[p] & auto.lengths[q]) > 0
        p, q, word_p, word_q, not_code = (x[able] for x in (p, q, word_p, word_q, not_code))
        ends = auto.final[p] & auto.final[q]
        if ends.any():
            yield word_p[ends], word_q[ends]
        if not len(keys) or not len(p):
            continue
        of, arc = _spread(auto.first, p)
        want = q[of] * auto.base + auto.code[arc]
        there = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        good = (keys[there] == want) & (auto.code[arc] != not_code[of])
        of, arc, there = of[good], arc[good], there[good]
        if len(of):
            todo.extend(_slices(auto.target[arc], auto.target[there], word_p[of] + auto.before[arc], word_q[of] + auto.before[there], np.zeros(len(of), np.int64)))


def _replacements(auto: Acceptor, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs of different arcs of each state, the smaller code first."""
    of, arc = _spread(auto.first, state)
    later = auto.first[state[of] + 1] - arc - 1
    one = np.repeat(np.arange(len(of)), later)
    other = arc[one] + 1 + np.arange(len(one)) - np.repeat(np.cumsum(later) - later, later)
    start = word[of[one]]
    return auto.target[arc[one]], auto.target[other], start + auto.before[arc[one]], start + auto.before[other], np.zeros(len(one), np.int64)


def _drops(auto: Acceptor, state: np.ndarray, word: np.ndarray, onto: np.ndarray, onto_word: np.ndarray) -> tuple[np.ndarray, ...]:
    """A code read by the left side alone: it may not be the next one of the right side, or the first difference would lie behind."""
    of, arc = _spread(auto.first, state)
    return auto.target[arc], onto[of], word[of] + auto.before[arc], onto_word[of], auto.code[arc]


def one_edit_apart(auto: Acceptor, state: np.ndarray, word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of all pairs of words below the given states that one edit parts; ``word`` is the number of each state's first word."""
    todo = list(_slices(state, word))
    while todo:
        state, word = todo.pop()
        for edit in (_replacements(auto, state, word), _drops(auto, state, word, state, word)):
            yield from same_rest(auto, *edit)
        of, arc = _spread(auto.first, state)
        if len(of):
            todo.extend(_slices(auto.target[arc], word[of] + auto.before[arc]))


def first_code_apart(auto: Acceptor, state: np.ndarray, word: np.ndarray, onto: np.ndarray, onto_word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As ``one_edit_apart`` for edits of the first code alone; words that drop it are completed from ``onto`` (-1: from nowhere)."""
    yield from same_rest(auto, *_replacements(auto, state, word))
    has = onto >= 0
    yield from same_rest(auto, *_drops(auto, state[has], word[has], onto[has], onto_word[has]))
