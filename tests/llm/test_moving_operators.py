"""Sharding and top-k search."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import shard_shuffle, topk_search


def test_draws_follow_the_hypergeometric_law():
    rng, n = np.random.default_rng(5), 4000
    for good, bad, taken in ((5, 7, 4), (60, 40, 30), (1, 9, 5), (10**10, 3 * 10**10, 10**6)):
        drawn = [shard_shuffle.draw(good, bad, taken, rng) for _ in range(n)]
        share = good / (good + bad)
        mean, variance = taken * share, taken * share * (1 - share) * (good + bad - taken) / (good + bad - 1)
        assert abs(np.mean(drawn) - mean) < 5 * math.sqrt(variance / n) + 1e-9
        assert abs(np.var(drawn) / variance - 1) < 0.15
    assert shard_shuffle.draw(0, 5, 3, rng) == 0 and shard_shuffle.draw(5, 0, 3, rng) == 3


def test_matrix_margins():
    parts, shards = [7, 0, 100, 3], shard_shuffle.shard_sizes(110, 4)
    matrix = np.array(shard_shuffle.draw_matrix(parts, shards, np.random.default_rng(1)))
    assert matrix.sum(axis=1).tolist() == parts and matrix.sum(axis=0).tolist() == shards == [28, 28, 27, 27]


def test_shards_are_exact_and_stable(spark):
    rows = [(i % 40 if i % 7 else None, "same" if i < 60 else f"t{i}", i, -1, {"k": i}) for i in range(203)] + [(3, None, 0, 0, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, shard int, m map<string,int>").repartition(5)
    out = shard_shuffle.shuffle_into_shards(df, 8, seed=3, groups=2, bucket_rows=5)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "n", "m", "shard", "slot"]
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(map(len, slots.values()), reverse=True) == shard_shuffle.shard_sizes(205, 8)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert sorted(str((r["doc_id"], r["text"], r["n"])) for r in got) == sorted(str((r[0], r[1], r[2])) for r in rows)
    assert sorted(map(str, got)) == sorted(map(str, out.collect()))
    assert shard_shuffle.shuffle_into_shards(df.limit(0), 8).count() == 0


def test_every_place_is_equally_likely(spark):
    """Over many seeds a row stands in every shard about equally often."""
    df = spark.range(12).withColumn("x", F.lit(0)).repartition(2).cache()
    counts = np.zeros(3)
    for seed in range(5):
        out = shard_shuffle.shuffle_into_shards(df, 3, seed=seed, groups=1, bucket_rows=2)
        for r in out.where("id < 6").collect():
            counts[r["shard"]] += 1
    assert counts.sum() == 30 and counts.min() >= 2
    df.unpersist()


def brute(rows, k, scale=1024.0):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v and i is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in {i: v for i, v in sorted(good, reverse=True) if i % 100 == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def test_top_k_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(350)]
    rows += [(1000 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 1.0]) for i in range(150)]  # one vector many times: ties
    rows += [(2000, None), (2001, []), (2002, [1.0, None]), (2003, [float("nan")] * 6), (2004, [float("inf")] * 6), (2100, [2.0, 1.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int").repartition(7)
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()], 10)
    got = topk_search.top_k(df, F.col("vec_id") % 100 == 0, k=10, query_block=3, row_block=40)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == want


def test_top_k_of_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (100, [1.0, -2.0]), (3, [0.0, 0.0])], schema)
    got = {tuple(r) for r in topk_search.top_k(few, F.col("vec_id") % 100 == 0).collect()}
    assert got == {(0, 1, 3, 0), (0, 2, 100, -3145728), (100, 1, 3, 0), (100, 2, 0, -3145728)}
    assert topk_search.top_k(few.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert topk_search.top_k(few.where("vec_id = 3"), F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(Exception, match="32 bits"):
        topk_search.top_k(spark.createDataFrame([(0, [1e9])], schema), F.col("vec_id") % 100 == 0)


def test_every_row_of_a_repeated_query_id_is_asked(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0]), (200, [1.0, 1.0]), (200, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(tuple(r) for r in topk_search.top_k(df, F.col("vec_id") % 100 == 0, k=2, scale=1.0, query_block=2, row_block=2).collect())
    assert got == sorted([
        (100, 1, 2, 3), (100, 2, 1, 1), (100, 1, 1, 2), (100, 2, 2, 1),
        *[(200, 1, 2, 4), (200, 2, 1, 3)] * 2,
    ])
