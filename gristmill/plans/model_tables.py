"""Fitted models as tables: trees by node, scores by walking them, importances, gradients, scores of the folds.

What a model says can then be recomputed by joins and aggregations, here or in any SQL engine.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators.quality import union_all
from gristmill.plans import forests
from gristmill.plans.modeling import KEY, TARGET, feature_names
from gristmill.scratch import materialize, step_path

#: Levels of the trees that rows walk down between two writes.
LEVELS = 8


def forest_nodes(forest: RandomForestClassificationModel | forests.GrownForest, spark: SparkSession) -> DataFrame:
    """One row per node: tree, node, feature (NULL in a leaf), cut, categorical, left, right, gain, weight, share (of the positive class).

    A forest of the library is saved to the shared folder and its node table read back; nothing is collected.
    """
    if isinstance(forest, forests.GrownForest):
        return materialize(forest.nodes(), "nodes")
    path = step_path(spark, "forest")
    forest.write().save(path)
    n = "nodeData"
    leaf = F.col(f"{n}.leftChild") < 0
    weight = F.aggregate(f"{n}.impurityStats", F.lit(0.0), lambda a, x: a + x)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col(f"{n}.id").alias("node"),
        F.when(~leaf, F.col(f"{n}.split.featureIndex")).alias("feature"), F.col(f"{n}.split.leftCategoriesOrThreshold").alias("cut"),
        (F.col(f"{n}.split.numCategories") >= 0).alias("categorical"), F.col(f"{n}.leftChild").alias("left"), F.col(f"{n}.rightChild").alias("right"),
        F.col(f"{n}.gain").alias("gain"), weight.alias("weight"), (F.col(f"{n}.impurityStats")[1] / weight).alias("share"),
    )


def model_cells(fitted: PipelineModel, rows: DataFrame, *columns: str) -> DataFrame:
    """The vector that the model sees as an array ``cells``, with the named columns."""
    prepared = PipelineModel(fitted.stages[:-1]).transform(rows)
    return prepared.select(*columns, vector_to_array("features").alias("cells"))


def score_by_nodes(rows: DataFrame, nodes: DataFrame, trees: int, key: str = KEY) -> DataFrame:
    """``key, probability``: every row walks down every tree, one join a level; the mean share of the leaves it ends in.

    Rows carry their cells, so a level needs the node table alone, which the planner broadcasts as long as it is small.
    Rows that have reached a leaf leave the walk at the next write.
    """
    inner = nodes.where(F.col("feature").isNotNull()).select("tree", "node", "feature", "cut", "categorical", "left", "right")
    leaves = nodes.where(F.col("feature").isNull()).select("tree", "node", "share")
    walking = rows.select(key, "cells", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    value = F.element_at("cells", F.col("feature") + 1)
    to_left = F.when(F.col("categorical"), F.array_contains("cut", value)).otherwise(value <= F.col("cut")[0])
    after = F.when(F.col("feature").isNull(), F.col("node")).when(to_left, F.col("left")).otherwise(F.col("right"))
    ended = []
    while True:
        for _ in range(LEVELS):
            walking = walking.join(inner, ["tree", "node"], "left").select(key, "cells", "tree", after.alias("node"))
        walking = materialize(walking, "walk")
        ended.append(walking.join(leaves, ["tree", "node"]).groupBy(key).agg(F.sum("share").alias("share")))
        walking = walking.join(leaves.select("tree", "node"), ["tree", "node"], "left_anti")
        if walking.isEmpty():
            return union_all(ended).groupBy(key).agg((F.sum("share") / trees).alias("probability"))


def importance_by_nodes(nodes: DataFrame, names: list[str]) -> DataFrame:
    """``feature, importance``: gain times weight of the nodes that split on a feature, normalised a tree and then over all."""
    gains = nodes.where(F.col("feature").isNotNull()).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("gain"))
    gains = materialize(gains, "gains")
    of_tree = gains.groupBy("tree").agg(F.sum("gain").alias("whole")).where("whole > 0")
    shares = materialize(gains.join(of_tree, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("whole")).alias("part")), "shares")
    named = nodes.sparkSession.createDataFrame(list(enumerate(names)), "at int, name string")
    part = F.coalesce(F.col("part") / shares.agg(F.sum("part")).scalar(), F.lit(0.0))
    return named.join(shares, F.col("at") == F.col("feature"), "left").select(F.col("name").alias("feature"), part.alias("importance"))


def logistic_gradient(fitted: PipelineModel, train: DataFrame) -> DataFrame:
    """``feature, gradient`` of the weighted, penalised mean loss at the fitted coefficients: all near zero where the fit has ended.

    One pass: each row adds its weighted error times its cells, features without a value add nothing.
    """
    model: LogisticRegressionModel = fitted.stages[-1]
    names, slopes, penalty = feature_names(fitted), [float(c) for c in model.coefficients], model.getRegParam()
    scored = fitted.transform(train)
    error = F.col("class_weight") * (vector_to_array("probability")[1] - F.col(TARGET))
    cells = scored.select(error.alias("error"), F.array_append(vector_to_array("features"), F.lit(1.0)).alias("cells"))
    sums = cells.select("error", F.posexplode("cells").alias("at", "value")).where("value <> 0").groupBy("at").agg(F.sum(F.col("error") * F.col("value")).alias("slope"))
    weight = train.agg(F.sum("class_weight")).scalar()
    own = [*((i, name, penalty * slope) for i, (name, slope) in enumerate(zip(names, slopes, strict=True))), (len(names), "intercept", 0.0)]
    known = train.sparkSession.createDataFrame(own, "at int, feature string, pull double")
    slope = F.coalesce(F.col("slope"), F.lit(0.0)) / weight + F.col("pull")
    return known.join(sums, "at", "left").select("feature", slope.alias("gradient"))


def out_of_fold(found: CrossValidatorModel, folded: DataFrame) -> DataFrame:
    """``setting, fold, title, predicted, actual``: what each setting's models say of the rows they were not fitted on.

    The search has to keep its models (``collectSubModels``).
    """
    if isinstance(found.bestModel.stages[-1], forests.GrownForest):
        return union_all([votes_of_fold(models, folded.where(F.col("fold") == fold)) for fold, models in enumerate(found.subModels)])
    scored = []
    for setting in range(len(found.avgMetrics)):
        of_folds = [
            models[setting].transform(folded.where(F.col("fold") == fold)).select(
                F.lit(setting).alias("setting"), "fold", KEY, F.col("prediction").cast("int").alias("predicted"), F.col(TARGET).cast("int").alias("actual"))
            for fold, models in enumerate(found.subModels)
        ]
        scored.append(materialize(union_all(of_folds), "out-of-fold"))
    return union_all(scored)


def votes_of_fold(models: list[PipelineModel], rows: DataFrame) -> DataFrame:
    """What the models of one fold say of its rows; they share their preprocessing, so all of them score in one job."""
    prepared = PipelineModel(models[0].stages[:-1]).transform(rows).select("fold", KEY, F.col(TARGET).cast("int").alias("actual"), "features")
    numbered = materialize(prepared.withColumn("__row", F.monotonically_increasing_id()), "to-score")
    shares = forests.votes([model.stages[-1] for model in models], numbered, "__row")
    scored = forests.scored_columns(shares.join(numbered, F.col("id") == F.col("__row")), F.col("share"))
    return materialize(scored.select(F.col("forest").alias("setting"), "fold", KEY, F.col("prediction").cast("int").alias("predicted"), "actual"), "out-of-fold")


def f1_of_folds(scores: DataFrame) -> DataFrame:
    """``setting, titles, cv_f1``: F1 of each fold (0 when undefined), its mean over the folds."""
    both = lambda a, b: F.count_if((F.col("actual") == a) & (F.col("predicted") == b))
    hits, missed = 2 * both(1, 1), both(0, 1) + both(1, 0)
    folds = scores.groupBy("setting", "fold").agg(F.count("*").alias("titles"), F.coalesce(F.try_divide(hits, hits + missed), F.lit(0.0)).alias("f1"))
    return folds.groupBy("setting").agg(F.sum("titles").alias("titles"), F.avg("f1").alias("cv_f1"))
