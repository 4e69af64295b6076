"""Components, n-gram join, line dedup, suffix dedup, decontamination."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill.llm import components, decontaminate, line_dedup, ngram_join, suffix_dedup, token_lists
from gristmill.llm.components import connected, linked_groups, with_payload
from gristmill.llm.suffix_order import blind_trie, deep_shallow
from gristmill.llm.words import shingle_sets
from gristmill.scratch import materialize
from tests.llm.helpers import DOCUMENTS, Groups, contaminated, edit_distance, frame, jaccard_components, lines_kept, near_copies, removed_bytes, shingles, within


def test_connected_equals_union(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5001 + i) for i in range(60)]
    groups = Groups()
    for a, b in edges:
        groups.join(a, b)
    want = {x: groups.find(x) for e in edges if e[0] != e[1] for x in e}
    got = {r["id"]: r["root"] for r in connected(frame(spark, edges, "a long, b long")).collect()}
    assert got == want
    assert connected(frame(spark, [], "a long, b long")).count() == 0


@pytest.mark.parametrize("rounds", [0, 3])
def test_linked_groups_miss_no_link(spark, rounds):
    """Ids are numbers, linked when at most 3 apart: lists share tens, so few lists hold many ids."""
    rng = random.Random(6)
    ids = sorted({rng.randrange(400) for _ in range(160)})
    postings = frame(spark, [(t, i, 1, 10) for i in ids for t in {i // 10, (i + 5) // 10 + 1000}], "token long, id long, need long, size long")
    groups = Groups()
    for a in ids:
        for b in ids:
            if a < b <= a + 3:
                groups.join(a, b)
    got = linked_groups(postings, lambda pairs: pairs.where("b - a <= 3"), (1, 2), rounds)
    assert {r["id"]: r["root"] for r in got.collect()} == {i: groups.find(i) for i in ids if i in groups.above}


@pytest.mark.parametrize("asking, rows, counters", [(512, 1_000_000, 4_000_000), (2, 40, 8)])
def test_met_pairs_count_shared_tokens(spark, monkeypatch, asking, rows, counters):
    """Sets that lost some tokens of a common one: pairs with enough in common are found, in companies and parts of any size."""
    for name, value in (("ASKING", asking), ("MET_ROWS", rows), ("COUNTERS", counters)):
        monkeypatch.setattr(components, name, value)
    rng = random.Random(9)
    sets = {i: set(rng.sample(range(f * 100, f * 100 + 24), rng.randint(17, 23))) for f in range(3) for i in range(f * 40, f * 40 + 30)}
    need = {i: -(-3 * len(own) // 4) for i, own in sets.items()}
    postings = frame(spark, [(t, i, need[i], need[i] - 1, len(own)) for i, own in sets.items() for t in own], "token long, id long, need long, spare long, size long")
    linked = {(a, b) for a in sets for b in sets if a < b and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])}
    light = components._lightened(components._open(postings, None))
    found = [(r["a"], r["b"]) for r in components.met_pairs(light, (3, 4), (3, 7)).collect()]
    assert len(found) == len(set(found)) and linked <= set(found)
    assert all(4 * len(sets[a] & sets[b]) >= 2 * len(sets[a] | sets[b]) for a, b in found)
    groups = Groups()
    for a, b in linked:
        groups.join(a, b)
    some = frame(spark, sorted(linked)[:9], "a long, b long")
    for links in (None, some):
        got = linked_groups(postings, lambda pairs: pairs.join(frame(spark, sorted(linked), "a long, b long"), ["a", "b"], "left_semi"), (3, 4), 1, overlap=(3, 7), links=links)
        assert {r["id"]: r["root"] for r in got.collect()} == {i: groups.find(i) for i in sets if i in groups.above}


def test_a_family_asks_together(spark, monkeypatch):
    """Sets that lost a few tokens of a common one, half of them one group: its ids do not ask, the others share their companies."""
    steps, write = {}, components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, label="step": steps.setdefault(label, []).append(write(df, label)) or steps[label][-1])
    rng = random.Random(12)
    sets = {i: set(rng.sample(range(60), rng.randint(46, 52))) for i in range(120)}
    need = {i: -(-3 * len(own) // 4) for i, own in sets.items()}
    postings = frame(spark, [(t, i, need[i], need[i] - 1, len(own)) for i, own in sets.items() for t in own], "token long, id long, need long, spare long, size long")
    groups = frame(spark, [(i, 0) for i in range(60)], "id long, root long")
    light = components._lightened(components._open(postings, groups))
    found = {(r["a"], r["b"]) for r in components.met_pairs(light, (3, 4), (3, 7)).collect()}
    assert found >= {(a, b) for a in sets for b in sets if a < b and b >= 60 and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])}
    assert not any(b < 60 for _, b in found)
    asking = {r["id"] for r in steps["asking"][-1].select("id").collect()}
    assert asking and min(asking) >= 60
    assert steps["companies"][-1].count() * 10 <= len(asking)


def test_hot_tokens_take_many_buckets():
    """A token that a third of 9,000 ids have: no bucket holds most of its rows, and all shared tokens come back."""
    rng, buckets, chunks = random.Random(3), 4, []
    for c in range(18):
        rows = [(7 if i % 3 == 0 else rng.randrange(1 << 40), c * 500 + i) for i in range(500)]
        rows += [(1 << 39, c * 500)] if c in (2, 9) else []
        chunks.append(rows + ([(11, c * 500 + i) for i in range(70)] if c == 5 else [(11, 3000)] if c == 6 else []))
    groups = {}
    for rows in chunks:
        ids = sorted({i for _, i in rows})
        token, own = np.array([t for t, _ in rows], np.uint64), np.array([ids.index(i) for _, i in rows], np.uint32)
        for batch in token_lists.spread(token, own, np.zeros(len(rows), np.uint32), ids, [1] * len(ids), buckets):
            groups.setdefault(batch.column("bucket")[0].as_py(), []).append(batch)
    out, largest = set(), 0
    for bucket, batches in groups.items():
        got = token_lists.known_tokens((pa.scalar(bucket),), pa.Table.from_batches(batches), buckets).to_pylist()
        out |= {(r["token"], r["id"]) for r in got}
        largest = max(largest, sum(r["token"] == 7 for r in got))
    lists = {}
    for token, i in {x for rows in chunks for x in rows}:
        lists.setdefault(token, set()).add(i)
    assert out == {(t, i) for t, own in lists.items() if len(own) > 1 for i in own}
    assert largest < 3000 / 3


def test_payload_of_hot_ids(spark):
    pairs = frame(spark, [(1, i) for i in range(2, 60)] + [(70, 71)], "a long, b long")
    payload = frame(spark, [(i, f"v{i}") for i in range(1, 80)], "id long, value string")
    got = with_payload(pairs, payload, most=7).collect()
    assert sorted((r["a"], r["b"], r["pa"], r["pb"]) for r in got) == sorted([(1, i, "v1", f"v{i}") for i in range(2, 60)] + [(70, 71, "v70", "v71")])


def test_shingle_sets_do_not_depend_on_neighbours():
    texts = [b"", b"  ", b"One two\tTHREE four five six", b"one two three four five six", b"a b", b"b a", "é É x y z".encode(), b"a\x0bb\x0cc d e f " * 50]
    together, alone = shingle_sets(texts), [shingle_sets([t])[0] for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(together, alone))
    assert [len(s) for s in together] == [len(shingles(t.decode())) for t in texts]
    assert np.array_equal(together[2], together[3]) and not np.array_equal(together[4], together[5])


def corpus():
    rows = list(enumerate(near_copies(1) + near_copies(2, families=2, members=25, words=40, edits=3)))
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "a b c"), (504, "A  b\nc"), (505, "a b"), (506, "x" * 50_000)]
    return rows + [(600 + i, rows[0][1].upper()) for i in range(20)]


def test_ngram_join_equals_all_pairs(spark):
    rows = corpus()
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in rows], DOCUMENTS).withColumnRenamed("lang", "key").withColumnRenamed("source", "root").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == jaccard_components(rows)
    stays = sorted(r["doc_id"] for r in ngram_join.one_of_each(docs).collect())
    assert stays == sorted(i for i, (n, c) in got.items() if i == c or not n)
    assert ngram_join.one_of_each(docs).columns == docs.columns


def test_ngram_join_of_odd_tables(spark):
    docs = frame(spark, [(1, "a b c"), (1, "a b c"), (1, "other words here"), (None, "a b c"), (None, "p q"), (7, "p q"), (None, "z"), (2, None), (2, None)])
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in ngram_join.near_duplicates(docs).collect())
    assert got == sorted([("1", 1, "1")] * 3 + [("None", 1, "1"), ("None", 1, "7"), ("7", 1, "7"), ("None", 1, "None"), ("2", 0, "2"), ("2", 0, "2")])
    assert ngram_join.one_of_each(docs).count() == 5
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0 and ngram_join.one_of_each(docs.limit(0)).count() == 0


def lines_corpus():
    rng = random.Random(8)
    base = [" ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(1, 90))) for _ in range(40)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(base)
            if rng.random() < 0.5:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice(["", "x", " ", "QQ"]) + line[at + 1 :]
            lines.append(line.upper() if rng.random() < 0.2 else line)
        rows.append((i, "\n".join(lines)))
    return rows + [(90, None), (91, ""), (92, "\n\n \n"), (93, "\ta\r\nb\n"), (94, "a\nB"), (95, "k" * 30_000 + "\n" + "k" * 29_999 + "j")]


def test_plain_versions_agree_on_edit_distances():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert [within(a, b, k) for k in range(13)] == [edit_distance(a, b) <= k for k in range(13)]


def test_edit_distances_within_a_bound():
    rng = random.Random(15)
    for _ in range(400):
        one = "".join(rng.choice("abé") for _ in range(rng.randrange(25)))
        other = one if rng.random() < 0.2 else "".join(c for c in one if rng.random() < 0.8) + "".join(rng.choice("abc") for _ in range(rng.randrange(5)))
        distance = edit_distance(one, other)
        assert [line_dedup.edits_within(one, other, k) for k in range(30)] == [distance <= k for k in range(30)]


def test_line_dedup_equals_all_pairs(spark):
    rows = lines_corpus()
    docs = frame(spark, [(i, t, "line", "row", None if t is None else len(t)) for i, t in rows], DOCUMENTS).withColumnRenamed("lang", "line").withColumnRenamed("source", "row").repartition(3)
    want = lines_kept([r for r in rows if r[0] != 95])
    plain, kept, gone = line_dedup.without_repeated_lines(docs)
    got = {r["d"]: (r["kept"], r["gone"]) for r in plain.select(F.col("__0").alias("d"), kept.alias("kept"), gone.alias("gone")).collect()}
    assert {d: (k or "") for d, (k, _) in got.items() if d != 95} == {d: "\n".join(lines) for d, lines in want.items()}
    assert {d: n for d, (_, n) in got.items() if d != 95} == {d: len((t or "").split("\n")) - len(want[d]) for d, t in rows if d != 95}
    assert got[90][0] is None and edit_distance("ab", "b") == 1
    out = line_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert r["text"] is None or r["n_chars"] == len(r["text"])
    lost = {d for d, t in rows if d != 95 and (t or "").split() and not "".join(want[d]).split()}
    assert {r["doc_id"] for r in out.collect()} == {d for d, _ in rows} - lost


def changed_lines():
    """(line, other) that differ in one long word, a split word, or typos in a few places; their edit similarity is at least 0.9."""
    rng = random.Random(21)
    word = lambda low, high: "".join(rng.choice("abcdefghijklmnoprstuvwé") for _ in range(rng.randint(low, high)))
    for words in [4, 8, 12, 20, 40] * 12:
        own = [word(8, 10) for _ in range(words)]
        at, changed = rng.randrange(words), min(10, words * 8 // 10 - 1)
        line = " ".join(own)
        yield line, " ".join([*own[:at], word(changed, changed) + own[at][changed:], *own[at + 1 :]])
        yield line, " ".join([*own[:at], own[at][:4], own[at][4:], *own[at + 1 :]])
        typos = list(line)
        for place in rng.sample(range(len(line)), min(len(line) // 10, 4)):
            typos[place] = "x"
        yield line, "".join(typos)


def test_line_dedup_finds_changed_words(spark):
    pairs = list(changed_lines())
    assert all(line_dedup.edits_within(a, b, max(len(a), len(b)) // 10) for a, b in pairs)
    plain, _, n_gone = line_dedup.without_repeated_lines(frame(spark, [(2 * i + k, pair[k]) for i, pair in enumerate(pairs) for k in (0, 1)]))
    gone = {r["d"] for r in plain.select(F.col("__0").alias("d"), n_gone.alias("n")).collect() if r["n"]}
    assert gone == {d for i, (a, b) in enumerate(pairs) for d in (2 * i, 2 * i + 1) if d % 2 or i % 3}


def syllables(rng, size):
    """A line of so many characters, in a language of thirty syllables: runs of a word or two are common."""
    out = ""
    while len(out) < size:
        out += "".join(rng.choice("th er on ti in an re ed at en st or es he nd ou ea ha is it ar te se hi al ne le ma ri co".split()) for _ in range(rng.randint(1, 3))) + " "
    return out[:size].strip()


def test_line_dedup_finds_edits_all_over_long_lines(spark):
    """A tenth of the characters replaced, evenly spread: no run of ten bytes stays whole."""
    rng = random.Random(31)
    rows = []
    for i in range(60):
        line = list(syllables(rng, 900))
        rows.append((2 * i, "".join(line)))
        for place in range(5, len(line) - 10, 10):
            line[place] = "q"
        rows.append((2 * i + 1, "".join(line)))
    assert all(line_dedup.edits_within(a, b, len(a) // 10) for (_, a), (_, b) in zip(rows[::2], rows[1::2]))
    plain, _, n_gone = line_dedup.without_repeated_lines(frame(spark, rows))
    got = {r["d"]: r["n"] for r in plain.select(F.col("__0").alias("d"), n_gone.alias("n")).collect()}
    assert sum(got[2 * i + 1] for i in range(60)) >= 57 and not any(got[2 * i] for i in range(60))


def test_beginnings_tell_no_linked_lines_apart(spark):
    rng, told = random.Random(33), 0
    for size in [200, 201, 255, 400, 900] * 12:
        line = syllables(rng, size)
        other = list(line)
        for place in sorted(rng.sample(range(len(line) if rng.random() < 0.5 else len(line) // 3), len(line) // 10 - 1), reverse=True):
            other[place : place + 1] = rng.choice(["", "q", "qq"])
        pairs = [(line, "".join(other)), (line, syllables(rng, size))]
        values = frame(spark, [(i, v) for i, v in enumerate(v for p in pairs for v in p)], "id long, value string") if size == 255 and not told else None
        if values is not None:
            assert {r["id"]: r["value"] for r in line_dedup.heads(values).collect()} == {i: v[: len(v) * 4 // 10] if len(v) >= 200 else v for i, v in enumerate(v for p in pairs for v in p)}
        for x, y in pairs:
            one, other = (v[: len(v) * 4 // 10] if len(v) >= 200 else v for v in (x, y))
            may = line_dedup.may_begin_alike(one, other)
            assert may or not line_dedup.edits_within(x, y, max(len(x), len(y)) // 10)
            told += not may
    assert told > 50


def test_unlike_lines_of_one_language_are_no_candidates(spark, monkeypatch):
    steps, write = {}, line_dedup.materialize
    monkeypatch.setattr(line_dedup, "materialize", lambda df, label="step": steps.setdefault(label, write(df, label)))
    rng = random.Random(32)
    rows = [(i, syllables(rng, rng.choice([350, 700, 1400]))) for i in range(1500)]
    assert line_dedup.repeated_lines(frame(spark, rows)).count() == 0
    assert steps["wanted"].count() < 150


def test_sketch_tokens_are_even_in_all_buckets():
    """The smallest hashes of long lines gathered in the first bucket of their class, which one task then held whole."""
    rng = random.Random(34)
    _, _, _, sizes, forms, begins = line_dedup._measured(["\n".join(syllables(rng, 700) for _ in range(300)).encode()])
    tokens = next(entry[1] for entry in line_dedup.line_tokens(forms, begins, sizes) if line_dedup.CLASSES[entry[0]][0] == 500)
    shares = np.bincount((tokens >> np.uint64(token_lists.TOKEN_BITS - 2)).astype(np.int64), minlength=4) / len(tokens)
    assert len(shares) == 4 and shares.min() > 0.2


def test_many_forms_are_compared_as_one_by_one():
    rng = random.Random(35)
    ones, others = [], []
    for size in [1, 5, 63, 64, 65, 130, 300] * 12:
        one = "".join(rng.choice("abcdeé ") for _ in range(size))
        ones.append(one)
        others.append("".join(rng.choice(["", "x", "yz"]) if rng.random() < 0.1 else c for c in one) or "x")
    for k in (0, 3, 20, 60):
        want = [line_dedup.edits_within(x, y, k) for x, y in zip(ones, others)]
        assert line_dedup.forms_within(ones, others, np.full(len(ones), k)).tolist() == want


def test_families_of_lines_meet_as_postings(spark):
    """Eighty versions of a line: their lists are crowded and go on instead of pairs."""
    rng = random.Random(36)
    base = syllables(rng, 180)
    rows = [(i, base[:at] + "#" + base[at + 1 :]) for i, at in enumerate(rng.sample(range(len(base)), 80))]
    assert line_dedup.repeated_lines(frame(spark, rows)).count() == 79


def test_families_are_connected_by_few_verified_pairs(spark, monkeypatch):
    rng = random.Random(31)
    first = " ".join(rng.choice(["harbour", "violin", "lantern", "orchard", "thunder", "compass"]) + str(rng.randrange(90)) for _ in range(20))
    # of a chain each line is linked to its neighbours alone; of a family all are linked
    step = len(first) // 14
    chain = [first[:20] + "#" * (step * k) + first[20 + step * k :] for k in range(8)]
    family = [first[::-1] + f" {k % 10}{k // 10}" for k in range(40)]
    forms = frame(spark, list(enumerate(chain + family)), "id long, value string")
    printed = materialize(line_dedup.printed(forms), "printed")
    lines = chain + family
    close = [(a, b, max(len(lines[a]), len(lines[b]))) for a in range(48) for b in range(a + 1, 48) if (a < 8) == (b < 8)]
    wanted = [(a, b) for a, b, size in close if line_dedup.edits_within(lines[a], lines[b], size // 10)]
    alike = materialize(line_dedup.printed_alike(frame(spark, close, "a long, b long, size long"), printed), "alike")
    tried, verify = [], line_dedup.similar_lines
    monkeypatch.setattr(line_dedup, "similar_lines", lambda pairs, own: tried.append(pairs.count()) or verify(pairs, own))
    links, groups = line_dedup.connecting_links(alike, printed)
    assert {(r["a"], r["b"]) for r in links.collect()} <= set(wanted) and len(wanted) > 780
    want = connected(frame(spark, wanted, "a long, b long"))
    assert sorted(groups.collect()) == sorted(want.collect()) and len({r["root"] for r in groups.collect()}) == 2
    assert sum(tried) < 150 and alike.count() > 800


def test_line_dedup_of_odd_tables(spark):
    docs = frame(spark, [(1, "one two\nx"), (1, "one two\nx"), (None, "x"), (2, "one two")])
    got = sorted((str(r["doc_id"]), r["text"]) for r in line_dedup.deduplicated(docs).collect())
    assert got == [("1", "one two"), ("1", "one two"), ("None", "x")]
    assert line_dedup.deduplicated(docs.limit(0)).count() == 0


def test_blind_tries_sort():
    rng = random.Random(9)
    for _ in range(60):
        strings = sorted({bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randint(2, 30))})
        shuffled = rng.sample(strings, len(strings))
        order, shared = blind_trie(shuffled)
        assert [shuffled[i] for i in order] == strings
        assert shared == [0] + [next(k for k in range(12) if a[k] != b[k]) for a, b in zip(strings, strings[1:])]


def test_deep_shallow_sorts_within_groups():
    rng = np.random.default_rng(3)
    rows = rng.integers(97, 99, (400, 104), dtype=np.uint8)
    rows[100:300, :60] = 97
    rows[150:200] = rows[100]
    group = rng.integers(0, 5, 400)
    order, shared = deep_shallow(rows, group)
    keys = [(group[i], rows[i].tobytes()) for i in order]
    assert keys == sorted((group[i], rows[i].tobytes()) for i in range(400))
    for place in range(1, 400):
        (g, a), (h, b) = keys[place - 1], keys[place]
        want = -1 if g != h else next((k for k in range(104) if a[k] != b[k]), 104)
        assert shared[place] == want


def suffix_corpus():
    rng = random.Random(11)
    passage = "".join(rng.choice("abcd ") for _ in range(400))
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 900)))) for i in range(20)]
    for i in range(20, 50):
        a, b = sorted((rng.randrange(400), rng.randrange(400)))
        rows.append((i, rows[i - 20][1][: rng.randrange(300)] + passage[a:b] + "é" * rng.randrange(3) + passage[: rng.randrange(250)]))
    rows += [(60, None), (61, ""), (62, "a" * 5000), (63, "a" * 99), (64, "a" * 100), (65, rows[30][1]), (66, "\x00" * 300), (67, "é" * 120)]
    return rows


def test_suffix_dedup_equals_brute_force(spark):
    rows = suffix_corpus()
    docs = frame(spark, [(i, t, "x", "y", 0) for i, t in rows], DOCUMENTS).withColumnRenamed("lang", "tag").withColumnRenamed("source", "starts").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.removal_digests(docs).collect()}
    want = {}
    for d, (raw, mask) in removed_bytes(rows).items():
        runs = sum(m and not (i and mask[i - 1]) for i, m in enumerate(mask))
        want[d] = (len(raw), sum(mask), runs, hashlib.sha256(bytes(x for x, m in zip(raw, mask) if not m)).hexdigest())
    assert got == want


def test_suffix_dedup_of_odd_tables(spark):
    rng = random.Random(14)
    text = "".join(rng.choice("abcdefgh ") for _ in range(260))
    docs = frame(spark, [(None, text), (5, text), (5, text), (5, text + "!"), (4, text[50:])])
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in suffix_dedup.removal_digests(docs).collect())
    assert got[:1] + got[-1:] == [("4", 210, 210), ("None", 260, 0)]
    assert sorted(r[1:] for r in got if r[0] == "5") == [(260, 260), (260, 260), (261, 260)]
    assert suffix_dedup.removal_digests(docs.limit(0)).count() == 0


def test_decontamination_equals_all_windows(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 12, 30])))) for i in range(12)] + [(20, None), (21, ""), (22, "go go go go go go go")]
    rows = []
    for d in range(60):
        own = [word() for _ in range(rng.randint(0, 60))]
        if d % 2:
            passage = rng.choice(items[:12])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                passage[rng.randrange(len(passage))] = "EDIT"
            at = rng.randint(0, len(own))
            own[at:at] = [w.upper() if d % 3 else w for w in passage]
        rows.append((d, "\n ".join(own)))
    rows += [(90, None), (91, ""), (92, "go " * 300), (93, "go go")]
    docs = frame(spark, [(d, t, "k", "h", 0) for d, t in rows], DOCUMENTS).withColumnRenamed("lang", "key").withColumnRenamed("source", "item")
    bench = frame(spark, items, "item_id long, text string")
    found = decontaminate.contaminated_windows(docs, bench)
    assert {r["doc_id"] for r in found.collect()} == contaminated(rows, items)
    assert all(r["hamming"] <= decontaminate.RADIUS for r in found.collect())
    left = decontaminate.clean_documents(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {d for d, _ in rows} - contaminated(rows, items)
    assert not any(w in left._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Pandas", "ArrowEval"))


def test_decontamination_of_odd_tables(spark):
    item = "one two three four five six seven"
    docs = frame(spark, [(1, item), (1, item), (1, "clean"), (None, "x " + item), (2, None)])
    bench = frame(spark, [(5, item), (5, item), (6, item.upper())], "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["item_id"], r["start_word"], r["shared"], r["total"]) for r in decontaminate.contaminated_windows(docs, bench).collect())
    assert got == [("1", 5, 0, 3, 3), ("1", 6, 0, 3, 3), ("None", 5, 1, 3, 3), ("None", 6, 1, 3, 3)]
    assert sorted(str(r["doc_id"]) for r in decontaminate.clean_documents(docs, bench).collect()) == ["1", "2"]
    assert decontaminate.clean_documents(docs, bench.limit(0)).count() == 5
    assert decontaminate.contaminated_windows(docs.limit(0), bench).count() == 0


def test_multi_index_finds_all_within_radius(spark):
    rng = random.Random(13)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 26)):
            b ^= 1 << bit
        signed = [x - (1 << 64) if x >> 63 else x for x in (a, b)]
        pairs.append((*signed, (a ^ b).bit_count()))
    df = frame(spark, pairs, "a long, b long, d int")
    met = df.select("d", F.arrays_overlap(decontaminate.block_values(F.col("a")), decontaminate.near_values(F.col("b"))).alias("met")).collect()
    assert all(r["met"] for r in met if r["d"] <= decontaminate.RADIUS)


def test_ngram_join_at_the_very_threshold(spark):
    """Sets of n - 1 and n shingles, and pairs of equal size that share exactly three quarters of the union."""
    rows, n = [], 0
    for size in (4, 8, 12, 16, 24):
        words = [f"w{size}x{i}" for i in range(size + 4)]
        rows += [(n, " ".join(words[:-1])), (n + 1, " ".join(words))]
        other = [f"v{size}x{i}" for i in range(size + 4)]
        cut = size * 3 // 4
        rows += [(n + 2, " ".join(other[: cut + 4])), (n + 3, " ".join(other))]
        n += 4
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(frame(spark, rows)).collect()}
    want = jaccard_components(rows)
    assert got == want and sum(i != c for i, (_, c) in want.items()) == 10
