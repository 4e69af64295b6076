"""Spelling variants: the acceptor against plain sets, the query against a brute-force version, hot prefixes, odd tables."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gristmill.llm import acceptor, queries, spelling

SF = "/root/testdata/sf0.001"
COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def near(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) - len(u) == 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def plain_vocabulary(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def expected(words):
    """Words by the strings that lose one character, every candidate checked."""
    by_gap = {}
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_gap.setdefault(key, set()).add(w)
    near_of = {w: set() for w in words}
    for own in by_gap.values():
        for u, v in itertools.combinations(sorted(own), 2):
            if near(u, v):
                near_of[u].add(v)
                near_of[v].add(u)
    form = {}
    for w, others in near_of.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best

    def last(w):
        return last(form[w]) if w in form else w

    return sorted(((w, n, len(near_of[w]), form.get(w), words.get(form.get(w)), last(w)) for w, n in words.items()))


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect())


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.QUERIES["op11_spelling"](spark, SF)) == expected(plain_vocabulary(rows))


@pytest.mark.parametrize("closed, part", [(12, 60), (45, 1 << 19), (10_000, 10)])
def test_parts_of_any_size_meet_every_pair_once(spark, closed, part):
    random = np.random.default_rng(closed)
    words = {"".join(random.choice(list("abÀz"), random.integers(5, 9))): int(random.integers(3, 40)) for _ in range(200)}
    # a prefix that most words begin with, words of one code again and again, words that are prefixes of others
    words |= {"prefix" + w: n for w, n in list(words.items())[:60]} | {"a" * k: k for k in range(5, 12)} | {"zebra": 5, "zebras": 50, "zebra" + "s" * 9: 4}
    words |= {"x" * 64 + w: n for w, n in list(words.items())[:9]} | {"y" * 63: 3, "y" * 64: 4, "y" * 65: 9, "y" * 66: 3, "y" * 300: 3, "y" * 301: 8}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    found = {r["word"]: (r["n_near"], r["best"], r["best_n"]) for r in spelling.near_words(table, closed, part).collect()}
    want = {}
    for w, n in words.items():
        others = [o for o in words if o != w and near(o, w)]
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            want[w] = (len(others), best, words[best])
    assert found == want


def build(words):
    codes = np.zeros((len(words), max(map(len, words))), np.int64)
    for i, w in enumerate(words):
        codes[i, : len(w)] = [ord(c) for c in w]
    return acceptor.minimised(codes, np.array([len(w) for w in words]))


def language(auto, state, number=0):
    own = [(number, "")] if auto.final[state] else []
    for arc in range(auto.first[state], auto.first[state + 1]):
        own += [(n, chr(auto.code[arc]) + rest) for n, rest in language(auto, auto.target[arc], number + auto.before[arc])]
    return own


def test_acceptor_is_minimal_numbers_its_words_and_composes():
    random = np.random.default_rng(1)
    for t in range(60):
        letters = list("abc"[: random.integers(1, 4)])
        words = sorted({"".join(random.choice(letters, random.integers(0 if t % 2 else 1, 7))) for _ in range(random.integers(1, 50))} - {""} or {"a"})
        auto = build(words)
        assert language(auto, auto.start) == list(enumerate(words))
        suffixes = [tuple(rest for _, rest in language(auto, s)) for s in range(len(auto.final))]
        assert len(set(suffixes)) == len(suffixes)
        found = [tuple(sorted(p)) for i, j in acceptor.one_edit_apart(auto, np.array([auto.start]), np.array([0])) for p in zip(i.tolist(), j.tolist())]
        assert sorted(found) == [(i, j) for i, j in itertools.combinations(range(len(words)), 2) if near(words[i], words[j])]


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (None, "nulls nulls nulls"), (3, "Straße STRASSE straße Straßé " * 4), (3, "same row rowss"), (3, "same row rowss"), (4, "a" * 5_000 + " "),
            (5, ("a" * 5_000 + " ") * 3), (6, ("a" * 4_999 + " ") * 7), (7, "tie-break tiers tieres tiert " * 3), (8, "chain chains chainst " + "chain " * 20 + "chains " * 8 + "chainst " * 3)]
    assert got(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(plain_vocabulary(rows))


def test_empty_table_and_clashing_columns(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = spark.createDataFrame([("no no no", 1, "words words words wordss", "w", 3)], "Text string, doc_id long, text string, word string, n int")
    assert got(spelling.variants(odd)) == expected(plain_vocabulary([(1, "words words words wordss")]))


def test_forms_chain_to_their_root(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("w11", None), ("x", "w3")], "word string, form string")
    assert {r["word"]: r["root"] for r in spelling.roots(forms).collect()} == {f"w{i}": "w11" for i in range(11)} | {"x": "w11"}
