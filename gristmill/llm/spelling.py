"""Grouping of spelling variants: words of the corpus that one edit parts, and the form each of them stands for.

The vocabulary is counted first, in tasks that send partial counts.  Pairs come from the
composition of the minimised vocabulary acceptor with a one-edit transducer and the
acceptor again (``acceptor``).  Spark partitions it by what follows the initial state: a
prefix that few words begin with is one part, in which both words of a pair read the
prefix alike.  A prefix that many words begin with is open: the edits of the code right
behind it are parts of their own, dealt out by what follows the edit, which both words
read alike, and the longer prefixes are partitioned further.  So every pair is
met in one part, at its first difference, and no part grows with the corpus.

Defined results: a null text has no words and a null id deletes no character; equal rows
all count; equal numbers go to the word first in code-point order; an empty table gives
no rows; words of any length are compared whole; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm import acceptor
from gristmill.llm.common import pick
from gristmill.scratch import materialize

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: A run whose check sum with the id is a multiple loses a character.
DELETED = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Words below a closed prefix (at least; no level has more than 2000 open prefixes), and characters a task composes.
CLOSED, LEVEL, PART = 20_000, 2000, 1 << 19
#: Words a counting task holds before it sends them, and the body length up to which words are compared all together.
HELD, LONG = 1 << 18, 64


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def sent() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        total.clear()
        return batch

    for batch in batches:
        for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            raw = value.as_py()
            if not raw:
                continue
            own = Counter(RUN.findall(raw.lower().decode("utf-8", "replace")))
            seed = zlib.crc32(f"{doc_id}:".encode())
            for run, n in own.items():
                if len(run) >= LEAST_LENGTH:
                    h = zlib.crc32(run.encode(), seed)
                    if doc_id is not None and h % DELETED == 0:
                        run = run[: h % len(run)] + run[h % len(run) + 1 :]
                        if len(run) < LEAST_LENGTH:
                            continue
                    total[run] += n
            if len(total) > HELD:
                yield sent()
    if total:
        yield sent()


def vocabulary(docs: DataFrame) -> DataFrame:
    """Words of at least five code points and three occurrences, with their counts."""
    return pick(docs, "doc_id", "text").mapInArrow(_runs, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _start(word, length) -> F.Column:
    return F.substring(word, F.lit(1), length)


def _after(word, length) -> F.Column:
    return F.substring(word, length + 1, F.char_length(word))


def with_depth(words: DataFrame, closed: int = CLOSED) -> DataFrame:
    """Adds ``depth``: the length of the shortest prefix that at most ``closed`` words begin with (more, where the vocabulary is large)."""
    total = words.count()
    closed = max(closed, total // LEVEL)
    if total <= closed:
        return words.withColumn("depth", F.lit(0))
    done, rest, depth = None, words, 1
    while True:
        rest = rest.withColumn("prefix", _start(F.col("word"), F.lit(depth)))
        # at most LEVEL rows, as each has more than one in LEVEL of all words
        still_open = materialize(rest.groupBy("prefix").count().where(F.col("count") > closed).select("prefix"), "open-prefixes")
        closes = rest.join(F.broadcast(still_open), "prefix", "left_anti").drop("prefix").withColumn("depth", F.lit(depth))
        done = closes if done is None else done.unionByName(closes)
        if still_open.isEmpty():
            return done
        rest = materialize(rest.join(F.broadcast(still_open), "prefix", "left_semi").drop("prefix"), "open-words")
        depth += 1


BELOW, LEFT, RIGHT = 0, 1, 2


def parts(words: DataFrame) -> DataFrame:
    """The rows each part needs: below a closed prefix whole words, at an open one words with and without the code behind it."""
    word, depth = F.col("word"), F.col("depth")
    item = lambda side, at, rest: F.struct(F.lit(side).alias("side"), _start(word, at).alias("prefix"), _after(word, at).alias("body"), rest.alias("rest"))
    at_open = lambda i: F.when(F.char_length(word) > i, F.array(item(LEFT, i, _after(word, i + 1)), item(RIGHT, i, _after(word, i)))).otherwise(
        F.array(item(RIGHT, i, _after(word, i))))
    opens = F.when(depth > 0, F.flatten(F.transform(F.sequence(F.lit(0), depth - 1), lambda i: F.when(F.char_length(word) >= i, at_open(i)).otherwise(F.array()))))
    below = F.array(item(BELOW, depth, F.lit(None).cast("string")))
    return words.select("n", F.explode(F.concat(below, F.coalesce(opens, F.array()))).alias("i")).select("n", "i.*")


def _composed(labels: np.ndarray, kinds: np.ndarray, onto: np.ndarray, label_of: np.ndarray, bodies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs among rows sorted by label and body; ``kinds`` and ``onto`` (label of the right side, or -1) belong to labels."""
    width = max(1, bodies.dtype.itemsize // 4)
    codes = np.zeros((len(bodies), width + 1), np.int64)
    codes[:, 0] = label_of + 1
    codes[:, 1:] = bodies.view(np.uint32).reshape(len(bodies), width) if bodies.dtype.itemsize else 0
    auto = acceptor.minimised(codes, (codes > 0).sum(axis=1))
    arcs = np.arange(auto.first[auto.start], auto.first[auto.start + 1])
    label = auto.code[arcs] - 1
    state, word = np.full(len(labels), -1, np.int64), np.zeros(len(labels), np.int64)
    state[label], word[label] = auto.target[arcs], auto.before[arcs]
    below, left = (label[kinds[label] == k] for k in (BELOW, LEFT))
    right = onto[left]
    found = [
        *acceptor.one_edit_apart(auto, state[below], word[below]),
        *acceptor.first_code_apart(auto, state[left], word[left], np.where(right >= 0, state[right], -1), np.where(right >= 0, word[right], 0)),
    ]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *(i for i, _ in found)]), np.concatenate([none, *(j for _, j in found)])


def pairs_of_part(sides: list[int], prefixes: list[str], bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all pairs of words that one edit parts and that belong to the part."""
    numbers: dict[tuple[int, str], int] = {}
    label_of = np.array([numbers.setdefault((s, p), len(numbers)) for s, p in zip(sides, prefixes)], np.int64)
    labels = list(numbers)
    kinds = np.array([s for s, _ in labels])
    onto = np.array([numbers.get((RIGHT, p), -1) if s == LEFT else -1 for s, p in labels], np.int64)
    sizes = np.array([len(b) for b in bodies], np.int64)
    # short bodies together; of long ones those of one length and the next, so that no matrix is wide for the sake of a few
    sets = [(0, np.flatnonzero(sizes <= LONG))]
    sets += [(n, np.flatnonzero((sizes == n) | (sizes == n + 1))) for n in np.unique(sizes[sizes >= LONG]).tolist()]
    sets += [(n - 1, np.flatnonzero(sizes == n)) for n in np.unique(sizes[sizes > LONG]).tolist() if not (sizes == n - 1).any()]
    one, other = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for shorter, rows in sets:
        if len(rows) < 2:
            continue
        own = np.array([bodies[i] for i in rows.tolist()])
        order = np.lexsort((own, label_of[rows]))
        i, j = (rows[order[x]] for x in _composed(labels, kinds, onto, label_of[rows][order], own[order]))
        if shorter:
            mine = np.minimum(sizes[i], sizes[j]) == shorter
            i, j = i[mine], j[mine]
        one.append(i)
        other.append(j)
    return np.concatenate(one), np.concatenate(other)


def _near_in_part(table: pa.Table) -> pa.Table:
    sides, prefixes, bodies, n = (table[c].to_pylist() for c in ("side", "prefix", "body", "n"))
    i, j = pairs_of_part(sides, prefixes, bodies)
    used = np.unique(np.concatenate([i, j]))
    words = {row: prefixes[row] + bodies[row] for row in used.tolist()}
    rank = np.zeros(len(sides), np.int64)
    rank[sorted(words, key=words.__getitem__)] = np.arange(len(words))
    counts = np.array(n, np.int64)
    left, right = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort((rank[right], -counts[right], left))
    left, right = left[order], right[order]
    row, begin, times = np.unique(left, return_index=True, return_counts=True)
    best = right[begin]
    return pa.table({
        "word": pa.array([words[r] for r in row.tolist()], pa.string()), "n_near": pa.array(times, pa.int64()),
        "best_n": pa.array(counts[best], pa.int64()), "best": pa.array([words[r] for r in best.tolist()], pa.string()),
    })


def near_words(words: DataFrame, closed: int = CLOSED, part: int = PART) -> DataFrame:
    """Per word with near words: how many, and the one of largest count (the first in code-point order of several)."""
    items = parts(with_depth(words, closed))
    size = items.agg(F.sum(F.char_length("body") + 1)).first()[0] or 0
    buckets = max(1, -(-size // part))
    dealt = items.withColumn("part", F.pmod(F.xxhash64("prefix", "rest"), F.lit(buckets))).drop("rest")
    found = dealt.groupBy("part").applyInArrow(_near_in_part, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", F.col("best.word").alias("best"), (-F.col("best.minus")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for words that have a form: chains of forms followed to their end, by doubling.  A form has twice the count, so chains are short."""
    links = materialize(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "form-links")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(further, "root", "left_semi").isEmpty():
            return links
        links = materialize(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "form-links")


def variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root: the vocabulary with the form and the last form of each word."""
    words = materialize(vocabulary(docs), "vocabulary")
    joined = words.join(near_words(words), "word", "left")
    strong = F.col("best_n") >= 2 * F.col("n")
    forms = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(strong, F.col("best")).alias("form"), F.when(strong, F.col("best_n")).alias("form_n"),
    ), "forms")
    return forms.join(roots(forms), "word", "left").withColumn("root", F.coalesce("root", "word"))
