"""Deep-shallow sorting of byte strings: multikey quicksort on words, then blind tries."""

from __future__ import annotations

import numpy as np

#: Bytes up to which strings are partitioned word by word; groups that agree so far go to blind tries.
SHALLOW = 32

_POWERS = np.array([1 << (8 * i) for i in range(1, 8)], np.uint64)


def _agreeing_bytes(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Leading bytes that two different big-endian words have in common."""
    return 7 - np.searchsorted(_POWERS, one ^ other, side="right")


def blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Sorted order of different strings of one length, and how many bytes each shares with the one before (0 for the first).

    An inner node keeps the depth where its strings part and one child per byte there.  A string goes down by those
    bytes alone, is compared once with the leaf it arrives at, and is hung in where the two part.
    """
    size = len(strings[0])
    numbers = [int.from_bytes(s, "big") for s in strings]
    root: object = 0
    for new in range(1, len(strings)):
        own, node = strings[new], root
        while isinstance(node, tuple):
            node = node[1].get(own[node[0]]) if own[node[0]] in node[1] else next(iter(node[1].values()))
        leaf = node
        part = size - ((numbers[new] ^ numbers[leaf]).bit_length() + 7) // 8
        above, node = None, root
        while isinstance(node, tuple) and node[0] < part:
            above, node = node, node[1][own[node[0]]]
        if isinstance(node, tuple) and node[0] == part:
            node[1][own[part]] = new
            continue
        fork = (part, {strings[leaf][part]: node, own[part]: new})
        if above is None:
            root = fork
        else:
            above[1][own[above[0]]] = fork
    order, shared, stack = [], [], [(root, 0)]
    while stack:
        node, common = stack.pop()
        if isinstance(node, tuple):
            children = [node[1][byte] for byte in sorted(node[1])]
            stack.extend((child, node[0]) for child in reversed(children[1:]))
            stack.append((children[0], common))
        else:
            order.append(node)
            shared.append(common)
    return order, shared


def deep_shallow(strings: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``strings`` (bytes, a multiple of 8 wide) by group and content, and the bytes shared with the row before.

    The second array is -1 where a group begins and the width where rows are equal.
    """
    n, width = strings.shape
    words = np.ascontiguousarray(strings).view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    shared = np.full(n, width, np.int64)
    head = np.ones(n, bool)
    head[1:] = np.diff(group[order]) != 0
    shared[head] = -1
    for depth in range(min(SHALLOW, width) // 8):
        several = ~(head & np.append(head[1:], True))
        at = np.flatnonzero(several)
        if not at.size:
            break
        part, key = np.cumsum(head)[at], words[order[at], depth]
        turn = np.lexsort((key, part))
        order[at], key = order[at][turn], key[turn]
        parted = np.flatnonzero((np.diff(key) != 0) & (np.diff(part) == 0)) + 1
        head[at[parted]] = True
        shared[at[parted]] = 8 * depth + _agreeing_bytes(key[parted], key[parted - 1])
    if width > SHALLOW and not head.all():
        inner = np.flatnonzero(~head)
        differs = np.zeros(n, bool)
        differs[inner] = (words[order[inner]] != words[order[inner - 1]]).any(axis=1)
        starts = np.append(np.flatnonzero(head), n)
        mixed = np.flatnonzero(np.add.reduceat(differs, starts[:-1]) > 0)
        for begin, end in zip(starts[mixed].tolist(), starts[mixed + 1].tolist()):
            members: dict[bytes, list[int]] = {}
            for row in order[begin:end].tolist():
                members.setdefault(strings[row].tobytes(), []).append(row)
            names = list(members)
            place = begin
            for name, common in zip(*blind_trie(names)):
                rows = members[names[name]]
                order[place : place + len(rows)] = rows
                if place > begin:
                    shared[place] = common
                place += len(rows)
    return order, shared
