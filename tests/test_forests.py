"""Forests grown in tasks: the rules of the library's trees, draws that hang on the seed alone, the library's forest beyond a task."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gristmill.plans import forests, model_tables, modeling


def rows_of(spark, n=600):
    return spark.range(n).selectExpr(
        "'t' || id AS title_clean", "'k' || (id * 13 % 4) AS type_clean", "id * 7919 % 1009 AS first_week_hours_viewed", "id * 31 % 17 AS first_week_rank",
        "CAST((id * 7919 % 1009 > 700) != (id % 7 = 0) AS INT) AS long_run_flag", "CASE WHEN id % 4 = 1 THEN 'test' ELSE 'train' END AS split")


SETTINGS = [
    {"n_estimators": 3, "max_depth": 3, "min_samples_leaf": 1, "max_features": "sqrt"},
    {"n_estimators": 4, "max_depth": None, "min_samples_leaf": 5, "max_features": None},
]


@pytest.mark.parametrize("leaf, depth", [(1, 30), (6, 30), (1, 4)])
def test_a_tree_on_all_rows_and_features_equals_the_librarys(spark, leaf, depth):
    rng = np.random.default_rng(5)
    n, weights = 400, (0.7, 1.9)
    cells = np.column_stack([rng.permutation(n) % 61, rng.integers(0, 2, n), rng.permutation(n) % 97, rng.integers(0, 5, n)]).astype(float)
    labels = (cells[:, 0] + 17 * cells[:, 1] + rng.integers(0, 40, n) > 55).astype(np.uint8)
    cuts = [(np.unique(c)[1:] + np.unique(c)[:-1]) / 2 for c in cells.T]
    bins = np.column_stack([np.searchsorted(c, v) for c, v in zip(cuts, cells.T)]).astype(np.uint8)
    settings = forests.Settings(1, depth, leaf, "all")
    (tree,) = forests.grow(bins, np.array([len(c) + 1 for c in cuts]), labels, np.array(weights), [np.ones(n, np.int64)], [None], settings)
    frame = spark.createDataFrame([(i, c.tolist(), int(y), weights[y]) for i, (c, y) in enumerate(zip(cells, labels))], "id int, cells array<double>, y int, w double")
    library = RandomForestClassifier(labelCol="y", weightCol="w", numTrees=1, maxDepth=depth, maxBins=128, minInstancesPerNode=leaf, featureSubsetStrategy="all", bootstrap=False, seed=1)
    fitted = library.fit(frame.coalesce(1).withColumn("features", array_to_vector("cells")))
    theirs = {r["id"]: r["probability"][1] for r in fitted.transform(frame.withColumn("features", array_to_vector("cells"))).collect()}
    own = forests.walked(tree, bins, tree["bin"])
    assert len(tree["feature"]) == fitted.totalNumNodes > 10
    assert [theirs[i] for i in range(n)] == pytest.approx(own.tolist(), abs=1e-12)
    gains = np.bincount(tree["feature"][tree["feature"] >= 0], (tree["gain"] * tree["weight"])[tree["feature"] >= 0], 4)
    # two features may cut a node equally well
    assert fitted.featureImportances.toArray() == pytest.approx(gains / gains.sum(), abs=1e-3)


def test_forests_and_searches_need_no_nodes_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(RandomForestClassifier, "fit", None)
    monkeypatch.setattr(RandomForestClassifier, "_fit", None)
    seen = []
    for layout in (rows_of(spark).coalesce(1), rows_of(spark).repartition(5, "first_week_rank")):
        fitted = modeling.fit_forest(layout, trees=9)
        nodes = sorted(map(str, model_tables.forest_nodes(fitted.model.stages[-1], spark).collect()))
        found, _ = modeling.search(modeling.parts_of(layout)[0], SETTINGS)
        seen.append((nodes, found.avgMetrics, sorted(map(str, fitted.scored.collect()))))
    # equal forests for every layout of the rows
    assert seen[0] == seen[1] and len(seen[0][0]) > 100
    assert found.bestModel.stages[-1].getNumTrees == SETTINGS[int(np.argmax(found.avgMetrics))]["n_estimators"]


@pytest.mark.parametrize("cells", [modeling.IN_TASK_CELLS, 0])
def test_both_forests_learn_the_rule_and_explain_their_search(spark, monkeypatch, cells):
    monkeypatch.setattr(modeling, "IN_TASK_CELLS", cells)
    fitted = modeling.fit_forest(rows_of(spark), trees=20)
    assert isinstance(fitted.model.stages[-1], forests.GrownForest) == (cells > 0)
    assert fitted.metrics().first()["roc_auc"] > 0.75
    train, _ = modeling.parts_of(rows_of(spark))
    found, _ = modeling.search(train, SETTINGS, keep_models=True)
    scores = model_tables.f1_of_folds(model_tables.out_of_fold(found, modeling.with_folds(train)))
    assert {r["setting"]: r["cv_f1"] for r in scores.collect()} == {i: pytest.approx(f1, abs=1e-12) for i, f1 in enumerate(found.avgMetrics)}


def test_small_parts_of_rows_and_trees_score_the_same(spark, monkeypatch):
    fitted = modeling.fit_forest(rows_of(spark), trees=9)
    monkeypatch.setattr(forests, "CHUNK", 7)
    monkeypatch.setattr(forests, "SCORED_ROWS", 40)
    monkeypatch.setattr(forests, "TREE_BYTES", 5_000)
    again = modeling.score(fitted.model, rows_of(spark).where("split = 'test'"))
    both = fitted.scored.alias("x").join(again.alias("y"), "title_clean").where("abs(x.long_run_probability - y.long_run_probability) < 1e-12")
    assert both.count() == fitted.scored.count() == 150
    monkeypatch.setattr(forests, "TOGETHER", 1)
    alone = modeling.fit_forest(rows_of(spark), trees=9)
    assert rows_as_text(alone) == rows_as_text(fitted)


def rows_as_text(fitted):
    return sorted(map(str, fitted.model.stages[-1].nodes().collect()))


def test_many_values_become_ranges(spark):
    cells = spark.range(5000).select(F.array(F.col("id").cast("double"), (F.col("id") % 2).cast("double"), F.lit(3.0)).alias("cells"))
    ranges, flag, same = forests.cuts_of(cells, 128)
    assert 120 <= len(ranges) <= 127 and (np.diff(ranges) > 0).all() and np.diff(ranges).max() < 80
    assert flag.tolist() == [0.5] and same.tolist() == []


def test_trees_are_dealt_out_evenly():
    parts = forests.dealt([5, 1, 1, 1, 1, 1], 2)
    assert sorted(sum(parts, [])) == list(range(6)) and sorted(map(len, parts)) == [1, 5]


def test_labels_other_than_0_and_1_raise(spark):
    with pytest.raises(ValueError, match="0 or 1"):
        modeling.fit_forest(rows_of(spark).withColumn("long_run_flag", F.col("long_run_flag") * 2), trees=2)
