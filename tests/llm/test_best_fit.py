"""Packing: ids by the library, laws of the layout, sums of squares by a plain version, odd tables."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gristmill.llm import best_fit, queries
from gristmill.scratch import materialize

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def library_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [e.ids + [1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_layout(rows, size):
    """Every sequence is filled gapless from 0 and holds at most ``size`` tokens."""
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


def expected_pieces(rows, size):
    out = Counter()
    for (doc_id, _), ids in zip(rows, library_ids([t for _, t in rows])):
        for piece, start in enumerate(range(0, len(ids), size)):
            own = ids[start : start + size]
            out[doc_id, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    return out


def as_pieces(rows):
    return Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)


def test_query_holds_every_token_of_the_table(spark):
    got = queries.QUERIES["op13_best_fit_packing"](spark, SF).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert as_pieces(got) == expected_pieces(docs, 4096)
    used = check_layout(got, 4096)
    total = sum(r["length"] for r in got)
    assert used <= -(-total // 4096) + 2


ODD = [
    (1, None), (2, ""), (None, "no id"), (3, "same row"), (3, "same row"), (4, "wo.rd " * 900), (5, " \n\t "), (6, "<|endoftext|> x"),
    (7, "Ünïcode é ́x 日本 語"), (8, "non breaking zero​width \x1f."), (9, "don't ...stop. It's!? 'tis"), (10, "a" * 5000), (11, "x" * 3 + "\x00y"),
]


@pytest.mark.parametrize("size", [7, 64, 4096])
def test_odd_texts(spark, size):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    cut = materialize(best_fit.pieces(docs, PATH, size=size, with_ids=True))
    got = best_fit.packed(cut, size=size, group_size=50).collect()
    assert as_pieces(got) == expected_pieces(ODD, size)
    check_layout(got, size)
    whole = best_fit.sequences(best_fit.packed(cut, size=size, group_size=50)).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["length"] for r in got)


def test_sequences_hold_their_pieces_in_order(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four"), (3, "five six")], "doc_id long, text string")
    cut = materialize(best_fit.pieces(docs, PATH, size=16, with_ids=True))
    rows = best_fit.sequences(best_fit.packed(cut, size=16)).collect()
    ids = dict(zip([1, 2, 3], library_ids(["one two three", "four", "five six"])))
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in rows] == [[i for d in r["doc_ids"] for i in ids[d]] for r in rows]
    assert sorted(d for r in rows for d in r["doc_ids"]) == [1, 2, 3]


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert best_fit.packed(materialize(best_fit.pieces(empty, PATH))).count() == 0
    odd = spark.createDataFrame([("y", 5, "a b", 1, 2)], "Text string, doc_id int, text string, number int, piece int")
    row = best_fit.packed(materialize(best_fit.pieces(odd, PATH))).first()
    assert (row["doc_id"], row["piece"], row["length"], row["offset"]) == (5, 0, 3, 0)


def plain_place(lengths, size, open_first):
    """Sums of squares recounted for every choice."""
    gaps, out = [], []
    for length in lengths:
        best = None
        fits = sorted({g for g in gaps if g >= length})
        for gap in fits if fits and open_first else [*fits, size + 1]:
            after = Counter(gaps)
            if gap <= size:
                after[gap] -= 1
            after[min(gap, size) - length] += 1
            total = sum(n * n for g, n in after.items() if 0 < g < size)
            if best is None or total < best[0]:
                best = (total, gap)
        gap = best[1]
        if gap <= size:
            gaps.remove(gap)
        out.append(size - min(gap, size))
        if min(gap, size) > length:
            gaps.append(min(gap, size) - length)
    return out


def test_choices_equal_recounted_sums():
    random = np.random.default_rng(5)
    for size in (5, 12, 40):
        lengths = np.sort(random.integers(1, size + 1, 120))[::-1]
        for order in (lengths, random.permutation(lengths)):
            for open_first in (True, False):
                sequence, offset = best_fit.place(order, size, open_first)
                assert offset.tolist() == plain_place(order.tolist(), size, open_first)
                assert np.bincount(sequence, order).max() <= size


def test_hot_lengths_and_many_groups(spark):
    rows = [(i, "w " * (30 if i % 3 else 7)) for i in range(3000)]
    cut = materialize(best_fit.pieces(spark.createDataFrame(rows, "doc_id long, text string"), PATH, size=100))
    got = best_fit.packed(cut, size=100, group_size=200).collect()
    used = check_layout(got, 100)
    assert len(got) == 3000 and used <= 770  # 750 is the least
