"""Fitted models as tables, recomputed by another engine."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks.learning_queries import safe_split
from gristmill.plans import evaluation, model_tables, modeling

SMALL = "/root/testdata/sf0.001"
SETTINGS = [
    {"n_estimators": 3, "max_depth": 3, "min_samples_leaf": 1, "max_features": "sqrt"},
    {"n_estimators": 4, "max_depth": None, "min_samples_leaf": 5, "max_features": None},
]


@pytest.fixture(scope="module")
def parts(spark):
    return safe_split(spark, SMALL)


@pytest.fixture(scope="module")
def grown(spark, parts):
    fitted = modeling.fit_forest(parts, trees=6)
    return fitted, model_tables.forest_nodes(fitted.model.stages[-1], spark)


WALK = """
WITH RECURSIVE walk AS (
  SELECT title_clean, cells, tree, 0 AS node FROM cells, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT w.title_clean, w.cells, w.tree, CASE WHEN CASE WHEN n.categorical THEN list_contains(n.cut, w.cells[n.feature + 1])
    ELSE w.cells[n.feature + 1] <= n.cut[1] END THEN n."left" ELSE n."right" END
  FROM walk w JOIN nodes n USING (tree, node) WHERE n.feature IS NOT NULL)
SELECT title_clean, avg(share) AS probability FROM walk JOIN nodes USING (tree, node) WHERE feature IS NULL GROUP BY title_clean"""

GAINS = """
WITH gains AS (SELECT tree, feature, sum(gain * weight) AS gain FROM nodes WHERE feature IS NOT NULL GROUP BY ALL),
parts AS (SELECT feature, sum(gain / whole) AS part FROM gains JOIN (SELECT tree, sum(gain) AS whole FROM gains GROUP BY tree) USING (tree) GROUP BY feature)
SELECT feature, part / (SELECT sum(part) FROM parts) FROM parts"""


def test_walks_equal_sql_and_the_forest(parts, grown, monkeypatch):
    fitted, nodes = grown
    monkeypatch.setattr(model_tables, "LEVELS", 3)
    cells = model_tables.model_cells(fitted.model, parts.where("split = 'test'"), "title_clean")
    walked = {r["title_clean"]: r["probability"] for r in model_tables.score_by_nodes(cells, nodes, 6).collect()}
    duck = duckdb.connect()
    duck.register("nodes", nodes.toArrow())
    duck.register("cells", cells.toArrow())
    by_sql = dict(duck.execute(WALK).fetchall())
    own = {r["title_clean"]: r["long_run_probability"] for r in fitted.scored.collect()}
    assert walked.keys() == by_sql.keys() == own.keys() and len(own) > 100
    for title, probability in own.items():
        assert walked[title] == pytest.approx(probability, abs=1e-12) and by_sql[title] == pytest.approx(probability, abs=1e-12)


def test_importances_equal_sql_and_the_forest(spark, grown):
    fitted, nodes = grown
    names = modeling.feature_names(fitted.model)
    got = {r["feature"]: r["importance"] for r in model_tables.importance_by_nodes(nodes, names).collect()}
    duck = duckdb.connect()
    duck.register("nodes", nodes.toArrow())
    by_sql = {names[i]: value for i, value in duck.execute(GAINS).fetchall()}
    own = {r["feature"]: r["importance"] for r in modeling.importance(fitted.model, spark).collect()}
    assert got.keys() == own.keys()
    for feature, value in own.items():
        assert got[feature] == pytest.approx(value, abs=1e-12) and by_sql.get(feature, 0.0) == pytest.approx(value, abs=1e-12)


def test_gradient_equals_a_dense_one_and_tells_an_unfinished_fit(parts):
    train, test = modeling.parts_of(parts)
    rows = train.count()
    unfinished = modeling.fit("few steps", modeling.logistic(rows).setMaxIter(2), train, test, rows).model
    got = {r["feature"]: r["gradient"] for r in model_tables.logistic_gradient(unfinished, train).collect()}
    seen = model_tables.model_cells(unfinished, train, "class_weight", modeling.TARGET).collect()
    x = np.array([[*r["cells"], 1.0] for r in seen])
    w, y = np.array([r["class_weight"] for r in seen]), np.array([r[modeling.TARGET] for r in seen])
    model = unfinished.stages[-1]
    beta = np.array([*model.coefficients, model.intercept])
    want = (w * (1 / (1 + np.exp(-x @ beta)) - y)) @ x / w.sum() + np.append(beta[:-1], 0.0) * model.getRegParam()
    assert got == pytest.approx(dict(zip([*modeling.feature_names(unfinished), "intercept"], want)), abs=1e-9)
    assert max(abs(v) for v in got.values()) > 1e-4


def test_out_of_fold_scores_explain_the_search(parts):
    train, _ = modeling.parts_of(parts)
    found, _ = modeling.search(train, SETTINGS, keep_models=True)
    scores = model_tables.out_of_fold(found, modeling.with_folds(train))
    rows = {r["setting"]: (r["titles"], r["cv_f1"]) for r in model_tables.f1_of_folds(scores).collect()}
    assert rows == {i: (train.count(), pytest.approx(f1, abs=1e-12)) for i, f1 in enumerate(found.avgMetrics)}
    assert scores.select("setting", "title_clean").distinct().count() == len(SETTINGS) * train.count()


def test_models_score_in_a_session_that_has_observed_a_write(spark, tmp_path):
    seen = Observation()
    spark.range(5).observe(seen, F.count("*").alias("n")).write.parquet(str(tmp_path / "seen"))
    assert seen.get == {"n": 5}
    rows = spark.range(80).selectExpr(
        "'t' || id AS title_clean", "CAST(id % 3 AS STRING) AS type_clean", "id % 7 AS rank", "CAST(id % 5 = 0 AS INT) AS long_run_flag",
        "CASE WHEN id % 4 = 0 THEN 'test' ELSE 'train' END AS split")
    assert modeling.fit_logistic(rows).scored.count() == modeling.fit_forest(rows, trees=2, depth=2).scored.count() == 20
    train, test = modeling.parts_of(rows)
    found, _ = modeling.search(train, SETTINGS[:1], keep_models=True)
    assert modeling.score(found.bestModel, test).count() == 20
    assert model_tables.out_of_fold(found, modeling.with_folds(train)).count() == 60


def test_train_rows_are_spread_over_the_cores_the_same_way_for_any_layout(spark):
    rows = spark.range(4000).selectExpr(
        "'t' || id AS title_clean", "CAST(id % 3 AS STRING) AS type_clean", "id % 5 AS rank", "CAST(id % 4 = 0 AS INT) AS long_run_flag", "'train' AS split")
    seen = []
    for layout in (rows.coalesce(1), rows.repartition(3, "rank")):
        train, _ = modeling.parts_of(layout)
        assert train.rdd.getNumPartitions() == 8 and train.drop("class_weight").exceptAll(rows.drop("split")).isEmpty()
        seen.append(sorted(tuple(r[0] for r in part) for part in train.select("title_clean").rdd.glom().collect()))
    assert seen[0] == seen[1] and sum(map(len, seen[0])) == 4000


def test_f1_without_a_hit_is_zero(spark):
    scores = spark.createDataFrame([(0, 0, "a", 0, 0), (0, 1, "b", 1, 1), (1, 0, "c", 0, 1)], "setting int, fold int, title_clean string, predicted int, actual int")
    assert {r["setting"]: r["cv_f1"] for r in model_tables.f1_of_folds(scores).collect()} == {0: 0.5, 1: 0.0}


def test_dashboard_rows_carry_the_search_score(parts):
    tuned, best_cv_f1 = modeling.fit_tuned(parts, settings=SETTINGS[:1])
    assert type(best_cv_f1) is float
    rows = evaluation.scored_output(tuned.scored, "long_run_probability", "actual", modeling.MODEL_VERSION).withColumn("best_cv_f1", F.lit(best_cv_f1)).collect()
    assert len(rows) > 100 and {r["best_cv_f1"] for r in rows} == {best_cv_f1}


def test_measures_follow_from_the_stored_scores(grown):
    fitted, _ = grown
    row = fitted.metrics().first()
    duck = duckdb.connect()
    duck.register("scored", fitted.scored.toArrow())
    accuracy, precision, recall, area = duck.execute("""
        SELECT avg(CAST(actual = predicted AS DOUBLE)), avg(actual) FILTER (WHERE predicted = 1), avg(predicted) FILTER (WHERE actual = 1),
          (SELECT avg(CASE WHEN p.s > n.s THEN 1.0 WHEN p.s = n.s THEN 0.5 ELSE 0.0 END)
           FROM (SELECT long_run_probability AS s FROM scored WHERE actual = 1) p, (SELECT long_run_probability AS s FROM scored WHERE actual = 0) n) FROM scored""").fetchone()
    assert (row["accuracy"], row["precision"], row["recall"]) == pytest.approx((accuracy, precision, recall), abs=1e-9)
    assert row["roc_auc"] == pytest.approx(area, abs=1e-9) and row["f1"] == pytest.approx(2 * precision * recall / (precision + recall), abs=1e-9)
