"""Secret scan: patterns, and sliding-window Shannon entropy per character class.

Candidate strings are maximal runs of key-like characters.  Within a candidate, each
maximal run of a character class at least one window long is swept by a window whose
character counts are updated by one character at a time; windows at or above the
class's entropy make up a span (overlapping ones merge).  Candidates that the allow
list matches whole are left out.  Pattern spans stand whatever the entropy says.

Defined results: a null text is empty and has no span; texts are scanned whole;
positions are code points, ends exclusive; equal rows give equal spans, and rows of
one id are reported each on its own.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import pick, texts

#: Fixed patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGNED_LENGTH = 8

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Kind, class, window and least entropy in bits.
CLASSES = (
    ("entropy_hex", re.compile(r"[0-9a-fA-F]{20,}"), 20, 3.0),
    ("entropy_base64", re.compile(r"[A-Za-z0-9+/]{20,}"), 20, 3.8),
    ("entropy_base64url", re.compile(r"[A-Za-z0-9_-]{20,}"), 20, 3.8),
)
#: A run of the last class that holds none of these is one of the class before as well, and is left to it.
URL_SAFE, URL_SAFE_ONLY = len(CLASSES) + 2, re.compile(r"[_-]")
#: Candidates that these match whole are no secrets: words with joints, numbers, the alphabet, rules.
ALLOWED = (
    re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)(?:[-_/+=](?:[A-Z]?[a-z]+|[A-Z]+))*[-_/+=]*"),
    re.compile(r"[0-9+/_=-]+"),
    re.compile(r"(?i:[0-9+/_=-]*abcdefghijklmnopqrstuvwxyz[0-9+/_=-]*)+"),
)
KINDS = ("assign", "access", "hex", *(name for name, *_ in CLASSES))

_UNIT = 1 << 40


def dense_spans(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged windows of ``text`` whose entropy is at least ``bits``; the counts move one character at a time.

    With counts c of a window of w characters the entropy is log2(w) - sum(c * log2(c)) / w.  The terms are whole
    numbers of 2**-40 bits, so the running sum is exact.
    """
    term = [0, 0] + [round(c * math.log2(c) * _UNIT) for c in range(2, window + 1)]
    most = round((math.log2(window) - bits) * window * _UNIT)
    counts: dict[str, int] = {}
    total, spans = 0, []
    for end, character in enumerate(text, 1):
        c = counts.get(character, 0)
        counts[character] = c + 1
        total += term[c + 1] - term[c] if c < window else 0
        if end > window:
            gone = text[end - window - 1]
            c = counts[gone]
            counts[gone] = c - 1
            total -= term[min(c, window)] - term[c - 1]
        if end >= window and total <= most:
            if spans and spans[-1][1] >= end - window:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((end - window, end))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern matches, in order of start and kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED_LENGTH]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def entropy_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of dense stretches outside the allow list."""
    found = []
    for candidate in CANDIDATE.finditer(text):
        own = candidate[0]
        if any(allowed.fullmatch(own) for allowed in ALLOWED):
            continue
        for kind, (_, members, window, bits) in enumerate(CLASSES, 3):
            for run in members.finditer(own):
                if kind == URL_SAFE and not URL_SAFE_ONLY.search(run[0]):
                    continue
                at = candidate.start() + run.start()
                found += [(at + start, kind, at + end) for start, end in dense_spans(run[0], window, bits)]
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans])


def spans_column(text: Column) -> Column:
    """Struct (n_assign, n_access, n_hex, base, spans) of each whole text; base and spans as ``kind:start:end`` lists."""

    @F.arrow_udf("n_assign long, n_access long, n_hex long, base string, spans string")
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])
            for text in texts(values):
                base = base_spans(text)
                kinds = [kind for _, kind, _ in base]
                row = (kinds.count(0), kinds.count(1), kinds.count(2), written(base), written(sorted(base + entropy_spans(text))))
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.StructArray.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["n_assign", "n_access", "n_hex", "base", "spans"]
            )

    return scanned(text)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, counts of the pattern kinds, ``base`` and ``spans``."""
    own = pick(docs, id_column, text_column)
    return own.select(id_column, spans_column(F.col(text_column)).alias("found")).select(id_column, "found.*")
