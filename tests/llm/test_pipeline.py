import corpus_pipeline
from gristmill.llm import queries
from gristmill.llm.settings import THRESHOLD, table
from tests.llm.helpers import contaminated, jaccard_components, lines_kept

SMALL = "/root/testdata/sf0.001"


def test_names():
    names = [n for n in queries.QUERIES if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries.QUERIES
    assert set(queries.EXPECTED) <= set(queries.QUERIES)


def test_stages_equal_plain_versions(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    columns, after = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if i < 4:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        after.append(docs.collect())
    texts = [{r["doc_id"]: r["text"] for r in rows} for rows in after[:4]]
    scores = {r["doc_id"]: r["score"] for r in queries.QUERIES["op3_quality"](spark, SMALL).collect()}
    assert set(texts[0]) == {d for d, s in scores.items() if s >= THRESHOLD}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SMALL, "labels").collect()}
    assert all(labels[d] for d in texts[0] if d in labels)

    kept = {d: "\n".join(lines) for d, lines in lines_kept(texts[0].items()).items()}
    assert texts[1] == {d: t for d, t in kept.items() if t.split() or not texts[0][d].split()}

    groups = jaccard_components(texts[1].items())
    assert set(texts[2]) == {d for d, (n, c) in groups.items() if d == c or not n}

    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    found = contaminated(texts[2].items(), items)
    assert found and set(texts[3]) == set(texts[2]) - found
    assert {r["doc_id"] for r in after[4]} == set(texts[3]) and all(r["round_trip"] and 4 * r["n_tokens"] == len(r["ids"]) for r in after[4])
