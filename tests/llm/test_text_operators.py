"""BPE, quality, secrets."""

import hashlib
import math
import random
import struct

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from gristmill.llm import byte_bpe, quality_qda, secret_scan
from gristmill.llm.settings import tokenizer
from tests.llm.helpers import frame

ODD = [None, "", " ", "a", "it's  the\n\n end ", "日本語 ßéñ 👍🏽", "ab" * 30_000, "x" * 70 + " " * 300 + "y", "<|endoftext|>", "\x00\x01"]


@pytest.fixture(scope="module")
def library():
    path, pattern = tokenizer()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})


def test_merges_equal_the_library(library):
    codec, rng = byte_bpe.codec(*tokenizer()), random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "é", " ", "\n", "the", "ing", "👍", "1", "!", "zq"]) for _ in range(rng.randrange(200)))
        packed = codec.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode_ordinary(text)
        assert codec.decode(packed) == text.encode()
    for raw in (b"abcabcabcabc" * 9, b"\xff\xfe\xfd", b"the the"):
        if raw not in codec.ranks:
            size = 1 << (len(raw) - 1).bit_length()
            ids, counts = byte_bpe.merge_many([raw, raw], codec.table, size)
            assert ids.tolist() == 2 * byte_bpe.merge_bytes(raw, codec.ranks) and counts[0] == counts[1]


def test_digests_of_odd_texts(spark, library):
    rows = [(i, t, 7, "z") for i, t in enumerate(ODD)] + [(0, None, 7, "z"), (None, "a", 7, "z")]
    docs = frame(spark, rows, "doc_id long, text string, n_tokens int, coded string").select("*", F.lit("other").alias("Text"))
    got = sorted(map(tuple, byte_bpe.token_digests(docs, *tokenizer()).collect()), key=str)
    want = []
    for i, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        raw = struct.pack(f"<{len(ids)}I", *ids)
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert byte_bpe.token_digests(docs.limit(0), *tokenizer()).count() == 0
    bad = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert bad.select(byte_bpe.encode(F.col("text"), *tokenizer())["decoded"]).first()[0] == "a�b".encode()


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    measured = quality_qda.measure(spark.read.parquet(f"{folder}/documents.parquet")).cache()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_qda.fit(measured.where(~quality_qda.held_out(F.col("doc_id"))), labels, "quality")
    scored = measured.where(quality_qda.held_out(F.col("doc_id"))).select("doc_id", model.column(F.col("statistics")).alias("score"))
    rows = scored.join(labels, "doc_id").select("score", "quality").collect()
    assert len(rows) > 500 and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([(r["score"] >= 0.3) == bool(r["quality"]) for r in rows]) > 0.99
    measured.unpersist()


def test_quality_of_odd_tables(spark):
    docs = frame(spark, [(i, t, 0.0, 1) for i, t in enumerate(ODD)] + [(None, "a b", 0.0, 1), (0, None, 0.0, 1)], "doc_id long, text string, statistics double, quality int")
    measured = quality_qda.measure(docs)
    assert all(all(math.isfinite(x) for x in r["statistics"]) for r in measured.collect())
    nothing = quality_qda.fit(measured, frame(spark, [], "doc_id long, quality int"), "quality")
    assert {r[0] for r in measured.select(nothing.column(F.col("statistics"))).collect()} == {0.5}
    one_class = quality_qda.fit(measured, frame(spark, [(1, 1), (2, 1), (3, None), (4, 5)], "doc_id long, quality int"), "quality")
    assert one_class == quality_qda.Model()
    both = quality_qda.fit(measured, frame(spark, [(1, 1), (2, 1), (6, 0), (6, 0), (None, 0)], "doc_id long, quality int"), "quality")
    assert all(0 <= r[0] <= 1 for r in measured.select(both.column(F.col("statistics"))).collect())
    assert quality_qda.fit(measured.limit(0), frame(spark, [(1, 1)], "doc_id long, quality int"), "quality") == quality_qda.Model()


def test_entropy_windows_equal_recounting():
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice("abc" if rng.random() < 0.5 else "abcdefghij0123456789") for _ in range(rng.randrange(70)))
        window, bits = rng.choice([4, 8, 20]), rng.choice([1.0, 1.9, 2.5, 3.0])
        covered = set()
        for p in range(len(text) - window + 1):
            own = text[p : p + window]
            entropy = -sum(own.count(c) / window * math.log2(own.count(c) / window) for c in set(own))
            if entropy >= bits - 1e-9:
                covered.update(range(p, p + window))
        assert {i for a, b in secret_scan.dense_spans(text, window, bits) for i in range(a, b)} == covered


def test_secret_kinds(spark):
    key = "AKIA" + "Z9" * 8
    rows = [
        (0, f'é password = "hunter2hunter2" {key}'), (1, "secret=token:abcdefghij TOKEN: short"), (2, "0123456789abcdef" * 2),
        (3, None), (4, ""), (5, "api_key: k9ZpQ2xW7vB4nM1cR8tY6uL3 and well-known-words-with-joints-are-fine"), (6, "ſecret=abcdefgh1"),
        (7, "AKIA" + "A" * 11), (0, "again " + "f" * 31),
    ]
    found = {(r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"]): r for r in secret_scan.scan(frame(spark, rows).withColumn("spans", F.lit(1))).collect()}
    assert set(found) == {(0, 1, 1, 0), (1, 0, 0, 0), (2, 0, 0, 1), (3, 0, 0, 0), (4, 0, 0, 0), (5, 1, 0, 0), (6, 0, 0, 0), (7, 0, 0, 0), (0, 0, 0, 0)}
    assert found[0, 1, 1, 0]["base"] == "assign:2:28,access:30:50"
    assert found[2, 0, 0, 1]["spans"].startswith("hex:0:32,entropy_hex:0:32")
    assert "entropy_base64" in found[5, 1, 0, 0]["spans"] and found[5, 1, 0, 0]["spans"].count("entropy") == 1
    assert found[3, 0, 0, 0]["spans"] == "" and secret_scan.scan(frame(spark, [])).count() == 0


def test_url_safe_keys_with_a_joint_at_every_place():
    key = "q7ZpR2xW9vB4nM1cK8tY6u"
    for joint in "-_":
        for place in range(len(key)):
            own = key[:place] + joint + key[place + 1 :]
            kinds = {kind: (start, end) for start, kind, end in secret_scan.entropy_spans(f"see {own} there")}
            assert kinds[secret_scan.KINDS.index("entropy_base64url")] == (4, 4 + len(own))
    several = "aZ3-kQ8_xP1-mW6_tR9-bY4_nC7-"
    assert [secret_scan.KINDS[kind] for _, kind, _ in secret_scan.entropy_spans(several)] == ["entropy_base64url"]
    assert secret_scan.entropy_spans("well-known-words_with-joints-are_no-secrets") == []
    assert [secret_scan.KINDS[kind] for _, kind, _ in secret_scan.entropy_spans(key)] == ["entropy_base64"]
