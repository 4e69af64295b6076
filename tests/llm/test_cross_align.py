"""Alignment: merge paths against plain intersections of ends, the query against the libraries, odd tables."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gristmill.llm import cross_align, merge_path, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_characters():
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def library_tokens(texts):
    """(ids, token bytes) of both sides a text, by the libraries over whole texts."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    characters = byte_characters()
    for text in texts:
        ids = first.encode(" " + text, add_special_tokens=False).ids
        yield ids, [bytes(characters[c] for c in first.id_to_token(i)) for i in ids]
        ids = second.encode(text)
        pieces = [second.id_to_piece(i) for i in ids]
        yield ids, [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, pieces)]


def expected(rows):
    out, all_links = [], []
    for doc_id, text in rows:
        if text:
            (ids_a, raw_a), (ids_b, raw_b) = library_tokens([text])
            want = (" " + text).encode()
        if not text or b"".join(raw_a) != want or b"".join(raw_b) != want:
            out.append((doc_id, 0, 0, 0, []))
            all_links.append([])
            continue
        ends_a = {int(e): i for i, e in enumerate(np.cumsum([len(t) for t in raw_a]))}
        ends_b = {int(e): i for i, e in enumerate(np.cumsum([len(t) for t in raw_b]))}
        groups, links, at_a, at_b = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a[end] + 1, ends_b[end] + 1
            groups.append(",".join(map(str, ids_a[at_a:i])) + "|" + ",".join(map(str, ids_b[at_b:j])))
            links.append((ids_a[i - 1], ids_b[j - 1]))
            at_a, at_b = i, j
        out.append((doc_id, len(ids_a), len(ids_b), len(groups), groups))
        all_links.append(links)
    counts = Counter(link for links in all_links for link in links)
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return sorted(
        (d is None, d, a, b, g, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for (d, a, b, g, groups), links in zip(out, all_links)
    )


def got(df):
    return sorted((r["doc_id"] is None, *(r[c] for c in COLUMNS)) for r in df.select(*COLUMNS).collect())


def test_query_equals_the_libraries(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.QUERIES["op12_cross_align"](spark, SF)) == expected(docs)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "\n"), (5, "  two  blanks \n\n x"), (6, "same text here"), (6, "same text here"), (7, "<s> </s> <|endoftext|>"),
    (8, "mark ▁ inside"), (9, "non breaking zero​width"), (10, "日本語 é é \U0001f600"), (11, "a" * 3000), (12, "tab\tand \r\n break"),
    (13, "word " * 2000), (14, "\x00 nul"), (15, "end. End! "), (16, "x\n y"),
]


@pytest.mark.parametrize("chunk", [10, 1 << 20])
def test_odd_texts(spark, monkeypatch, chunk):
    monkeypatch.setattr(cross_align, "CHUNK", chunk)
    assert got(cross_align.linked(spark.createDataFrame(ODD, "doc_id long, text string"), A, B)) == expected(ODD)


def test_empty_table_null_ids_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert cross_align.linked(empty, A, B).count() == 0
    odd = spark.createDataFrame([("no", None, "some words", 1, 2), ("no", None, None, 1, 2)], "Text string, doc_id int, text string, chunk int, number int")
    assert got(cross_align.linked(odd, A, B)) == expected([(None, "some words"), (None, None)])


def test_overlaps_of_the_general_form(spark):
    rows = [(1, "naïve approaches differ"), (2, None), (3, "one"), (4, "pneumonoultramicroscopic words")]
    for row in cross_align.aligned(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect():
        text = dict(rows)[row["doc_id"]]
        if not text:
            assert row["a_ids"] == [] and row["b_ids"] == [] and row["overlaps"] == []
            continue
        (ids_a, raw_a), (ids_b, raw_b) = library_tokens([text])
        assert row["a_ids"] == ids_a and row["b_ids"] == ids_b
        spans = lambda raw: [(int(e) - len(t), int(e)) for e, t in zip(np.cumsum([len(t) for t in raw]), raw)]
        want = []
        for i, (s, e) in enumerate(spans(raw_a)):
            for j, (u, v) in enumerate(spans(raw_b)):
                if max(s, u) < min(e, v):
                    want.append((i, j, max(s, u), min(e, v), e == v))
        assert [(o["a"], o["b"], o["start"], o["end"], o["ends_both"]) for o in row["overlaps"]] == sorted(want, key=lambda x: x[3])
        assert [o["group"] for o in row["overlaps"]] == [sum(x[4] for x in want[:i]) for i in range(len(want))]


@pytest.mark.parametrize("steps", [1, 2, 7, 64, 1000])
def test_pieces_of_any_size_give_the_same_overlaps(steps):
    random = np.random.default_rng(steps)
    for n in (0, 1, 5, 200, 3000):
        total = 3 * n + 1
        ends_a, ends_b = (np.sort(random.choice(np.arange(1, total + 1), n, replace=False)) for _ in range(2))
        if n:
            ends_a[-1] = ends_b[-1] = total
        over = merge_path.overlaps(ends_a.astype(np.int64), ends_b.astype(np.int64), steps)
        cuts = sorted(set(ends_a.tolist()) | set(ends_b.tolist()))
        assert over.end.tolist() == cuts and over.start.tolist() == [0, *cuts[:-1]][: len(cuts)]
        assert over.a.tolist() == np.searchsorted(ends_a, cuts).tolist() and over.b.tolist() == np.searchsorted(ends_b, cuts).tolist()
        common = np.intersect1d(ends_a, ends_b)
        assert over.end[over.ends_both].tolist() == common.tolist()
        assert over.group.tolist() == np.searchsorted(common, cuts).tolist()


def test_crossings_lie_on_the_merge():
    random = np.random.default_rng(3)
    for n, m in ((0, 5), (5, 0), (40, 3), (30, 30)):
        a, b = np.sort(random.integers(1, 30, n)), np.sort(random.integers(1, 30, m))
        side = [0] * n + [1] * m
        merged = [s for _, s in sorted(zip([*a, *b], side))]
        want = [merged[:d].count(0) for d in range(n + m + 1)]
        if n and m:
            assert merge_path.crossings(a, b, np.arange(n + m + 1)).tolist() == want
