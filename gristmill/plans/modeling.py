"""Split, preprocessing, classifiers and randomised search on a model input.

Preprocessing and model form one ``Pipeline`` that is fitted on train rows only.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.ordering import largest_first
from gristmill.operators.ordered import positions, smallest_hashes
from gristmill.operators.quality import union_all
from gristmill.plans import forests
from gristmill.plans.evaluation import metric_row
from gristmill.scratch import materialize, step_path

TARGET = "long_run_flag"
KEY = "title_clean"
ID_COLUMNS = ("title_clean", "show_title", "first_week_date")
TEST_SHARE = 0.25
SEED = 42
FOLDS = 3
# The searched space; None stands for "no limit" and "all features".
SEARCH_SPACE: Mapping[str, tuple] = {
    "n_estimators": (100, 200, 400),
    "max_depth": (None, 3, 5, 8),
    "min_samples_leaf": (1, 2, 5, 10),
    "max_features": ("sqrt", "log2", None),
}
SEARCH_DRAWS = 10
DEEPEST = 30  # the deepest tree the library grows
MOST_BINS = 128  # candidate cuts of a numeric column, of which there are at most as many as train rows
#: Train rows of one task: fewer are not worth a task, more make its passes long.
LEAST_ROWS, MOST_ROWS = 200, 50_000
#: Cells of the train rows, a byte each, up to which tasks grow whole trees (``forests``); beyond, the library's forest passes over the rows.
IN_TASK_CELLS = 100_000_000
MODEL_VERSION = "random_forest_randomized_v1"


def feature_columns(df: DataFrame) -> list[str]:
    """Everything but identifiers and the target."""
    return [c for c in df.columns if c not in ID_COLUMNS and c != TARGET]


def columns_by_kind(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Text columns and number (or boolean) columns."""
    kinds = {f.name: f.dataType for f in df.schema}
    text = [c for c in columns if isinstance(kinds[c], T.StringType)]
    numbers = [c for c in columns if isinstance(kinds[c], (T.NumericType, T.BooleanType))]
    return text, numbers


def key_hash(seed: int) -> Column:
    """Seeded hash of the key as text, the same in every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(KEY)).cast("binary"))


def split(df: DataFrame, share: float = TEST_SHARE, seed: int = SEED, exact: bool = True) -> DataFrame:
    """Add ``split`` (train or test), the same share of each class, fixed by key and seed.

    Exact takes the ``round(share * rows)`` rows of a class with the smallest
    key hashes, equal hashes by key.  Otherwise a hash threshold decides row by
    row: no shuffle, and the share is met up to chance.
    """
    if exact:
        flagged = smallest_hashes(df.withColumn("__hash", key_hash(seed)), TARGET, "__hash", KEY, share, "__test").drop("__hash")
    else:
        flagged = df.withColumn("__test", F.pmod(F.xxhash64(F.col(KEY), F.lit(seed)), F.lit(10_000)) < round(share * 10_000))
    return flagged.withColumn("split", F.when(F.col("__test"), "test").otherwise("train")).drop("__test")


def split_audit(split_df: DataFrame) -> DataFrame:
    """Rows and long-run rate of both parts."""
    return split_df.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.sum(TARGET).alias("long_run_count"),
        F.avg(TARGET).alias("long_run_rate"),
    ).select(
        F.concat("split", F.lit("_safe")).alias("dataset"),
        F.when(F.col("split") == "train", "model fit").otherwise("final evaluation").alias("role"),
        "rows", "long_run_count", "long_run_rate",
    ).orderBy(F.desc("dataset"))


def class_weights(train: DataFrame, label: str = TARGET) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = materialize(train.groupBy(label).agg(F.count("*").alias("class_rows")), "class-rows")
    total, classes = counts.agg(F.sum("class_rows")).scalar(), counts.agg(F.count(label)).scalar()
    return counts.withColumn("class_weight", total / (classes * F.col("class_rows")))


def with_class_weights(train: DataFrame) -> DataFrame:
    """Weight column on train rows.  The two weights become literals; a third class is an error."""
    rows = class_weights(train).limit(3).collect()
    if len(rows) > 2:
        raise ValueError(f"{TARGET} has more than two classes")
    weights = {row[TARGET]: row["class_weight"] for row in rows}
    weight: Column = F.lit(None).cast("double")
    for label, value in weights.items():
        weight = F.when(F.col(TARGET) == label, F.lit(value)).otherwise(weight)
    return train.withColumn("class_weight", weight)


def preprocess_stages(text: Sequence[str], numbers: Sequence[str], rows: int) -> list[Estimator]:
    """One-hot text columns (unseen values become all zeros), standardised numbers, one vector.

    The scaler divides by the sample deviation of the ``rows`` train rows; a fixed
    factor turns that into the population deviation.
    """
    stages: list = []
    parts: list[str] = []
    if text:
        indexed, encoded = [f"{c}_index" for c in text], [f"{c}_onehot" for c in text]
        stages += [
            StringIndexer(
                inputCols=list(text), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            ),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
        parts += encoded
    if numbers:
        stages += [
            VectorAssembler(inputCols=list(numbers), outputCol="numbers_raw"),
            StandardScaler(inputCol="numbers_raw", outputCol="numbers_scaled", withMean=True, withStd=True),
            ElementwiseProduct(
                inputCol="numbers_scaled", outputCol="numbers",
                scalingVec=Vectors.dense([(rows / max(1, rows - 1)) ** 0.5] * len(numbers)),
            ),
        ]
        parts.append("numbers")
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def estimator(df: DataFrame, rows: int, *model: Estimator) -> Pipeline:
    """Preprocessing for the feature columns of ``df`` with ``rows`` train rows, then the model, if any."""
    return Pipeline(stages=[*preprocess_stages(*columns_by_kind(df, feature_columns(df)), rows), *model])


def feature_cells(split_df: DataFrame, decimals: int = 6) -> DataFrame:
    """(title_clean, split, feature, value) in long form: what the models see, fitted on train rows; zeros are left out."""
    train = split_df.where(F.col("split") == "train").drop("split")
    fitted = estimator(train, train.count()).fit(train)
    cells = fitted.transform(split_df).select(KEY, "split", F.posexplode(vector_to_array("features")).alias("at", "value"))
    names = split_df.sparkSession.createDataFrame(list(enumerate(feature_names(fitted))), "at int, feature string")
    cells = cells.withColumn("value", F.round("value", decimals)).where("value <> 0")
    return cells.join(names, "at").select(KEY, "split", "feature", "value")


def logistic(train_rows: int) -> LogisticRegression:
    """Balanced logistic baseline with unit L2 strength (the mean loss needs it divided by the rows)."""
    return LogisticRegression(
        labelCol=TARGET, weightCol="class_weight", maxIter=1000, tol=1e-9, regParam=1.0 / train_rows,
        elasticNetParam=0.0, standardization=False,
    )


def forest(
    trees: int = 300, depth: int | None = None, leaf: int = 1, features: str | None = "sqrt", seed: int = SEED
) -> RandomForestClassifier:
    """Balanced random forest of the library, for train rows that do not fit a task.  Its driver holds all nodes.

    No depth limit means ``DEEPEST``.  Memory grows with depth, so give a
    smaller one when the train rows run into the billions.
    """
    return RandomForestClassifier(
        labelCol=TARGET, weightCol="class_weight", numTrees=trees, maxDepth=depth or DEEPEST, maxBins=MOST_BINS,
        minInstancesPerNode=leaf, featureSubsetStrategy=features or "all", seed=seed,
        cacheNodeIds=True,  # rows keep their place in each tree instead of walking down from the root
    )


@dataclass
class Fitted:
    """A fitted model with its scored test rows."""

    name: str
    model: PipelineModel
    scored: DataFrame

    def metrics(self) -> DataFrame:
        return metric_row(self.scored, self.name, "actual", "predicted", "long_run_probability")


def spread(rows: DataFrame, label: str) -> DataFrame:
    """Write rows dealt out by key over as many files as the cluster has cores, more if these get large.

    A fit runs one task a partition in every pass.  A narrow table takes up a single file, and all passes would run
    on one core.  Dealt and sorted by key, the parts, and with them the draws of a forest, do not depend on how the rows came.
    """
    count = rows.count()
    cores = min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(count / LEAST_ROWS))
    parts = max(1, cores, math.ceil(count / MOST_ROWS))
    return materialize(rows.repartition(parts, F.col(KEY)).sortWithinPartitions(KEY), label)


def parts_of(split_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weighted train rows, spread over the cores, and test rows."""
    train = split_df.where(F.col("split") == "train").drop("split")
    test = split_df.where(F.col("split") == "test").drop("split")
    return spread(with_class_weights(train), "train"), test


def without_weight(df: DataFrame) -> DataFrame:
    return df.drop("class_weight")


def score(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Test rows with probability, prediction and actual flag; written once, as measures read it repeatedly."""
    columns = [c for c in ("title_clean", "show_title", "type_clean", "primary_genre", "first_week_date") if c in test.columns]
    scored = model.transform(test).select(
        *columns,
        vector_to_array("probability")[1].alias("long_run_probability"),
        F.col("prediction").cast("int").alias("predicted"),
        F.col(TARGET).cast("int").alias("actual"),
    )
    return materialize(scored, "scored")


def detached(fitted: PipelineModel) -> PipelineModel:
    """The same model without its training summary.

    The summary holds the session.  Tasks that score carry the model, and a session that has observed any
    write can no longer be sent to them.  A copy drops the summary, where it does not the model is stored and read back.
    """
    stages = []
    for stage in fitted.stages:
        if getattr(stage, "hasSummary", False):
            stage = stage.copy()
        if getattr(stage, "hasSummary", False):
            path = step_path(SparkSession.active(), "model")
            stage.write().save(path)
            stage = type(stage).load(path)
        stages.append(stage)
    return PipelineModel(stages)


def fit(name: str, model: Estimator, train: DataFrame, test: DataFrame, rows: int) -> Fitted:
    """Fit preprocessing and model on the ``rows`` weighted train rows, score the test rows."""
    fitted = detached(estimator(without_weight(train), rows, model).fit(train))
    return Fitted(name, fitted, score(fitted, test))


def fit_logistic(split_df: DataFrame, name: str = "LogisticRegression_safe") -> Fitted:
    train, test = parts_of(split_df)
    rows = train.count()
    return fit(name, logistic(rows), train, test, rows)


def in_task(train: DataFrame, prepare: PipelineModel) -> bool:
    """Whether the cells that the models see of the train rows fit a task."""
    return train.count() * len(feature_names(prepare)) <= IN_TASK_CELLS


def grow_forests(prepared: Sequence[DataFrame], is_train: Column, fits: Sequence[tuple[int, forests.Settings]], seed: int = SEED, keep: bool = True) -> tuple[DataFrame, dict[int, forests.GrownForest]]:
    """The table of trees and, with ``keep``, the forest of every fit; ``prepared`` has the rows with ``features`` that fits name by number."""
    weights: list[float] = [1.0, 1.0]
    for row in prepared[0].groupBy(TARGET).agg(F.first("class_weight").alias("weight")).limit(3).collect():
        if row[TARGET] not in (0, 1):
            raise ValueError(f"{TARGET} has to be 0 or 1, not {row[TARGET]}")
        weights[int(row[TARGET])] = row["weight"]
    cuts = [forests.cuts_of(rows.where(is_train).select(vector_to_array("features").alias("cells")), MOST_BINS) for rows in prepared]
    packed = [forests.packed(rows, own, i, TARGET, is_train, F.col(KEY)) for i, (rows, own) in enumerate(zip(prepared, cuts))]
    trees = forests.grown(packed, list(fits), cuts, weights, seed, keep)
    if not keep:
        return trees, {}
    gains = forests.summed_gains(trees)
    return trees, {i: forests.GrownForest(trees, i, settings, *gains[i]) for i, (_, settings) in enumerate(fits)}


def fit_forest(split_df: DataFrame, name: str = "RandomForest_safe", trees: int = 300, depth: int | None = None) -> Fitted:
    train, test = parts_of(split_df)
    rows = train.count()
    prepare = detached(estimator(without_weight(train), rows).fit(train))
    if not in_task(train, prepare):
        return fit(name, forest(trees, depth), train, test, rows)
    _, grown = grow_forests([prepare.transform(train)], F.lit(True), [(0, forests.Settings(trees, depth or DEEPEST, 1, "sqrt"))])
    fitted = PipelineModel([*prepare.stages, grown[0]])
    return Fitted(name, fitted, score(fitted, test))


def leakage_comparison(safe_split: DataFrame, leakage_split: DataFrame) -> DataFrame:
    """The same baseline on both feature sets: too good a score points at hindsight columns."""
    return union_all([
        fit_logistic(safe_split).metrics(),
        fit_logistic(leakage_split, "LogisticRegression_leakage").metrics(),
    ])


def feature_names(fitted: PipelineModel) -> list[str]:
    """Names of the vector's parts in order: one per category value, then the numbers."""
    names: list[str] = []
    for stage in fitted.stages:
        if isinstance(stage, StringIndexerModel):
            for column, values in zip(stage.getInputCols(), stage.labelsArray):
                names += [f"categorical__{column}_{value}" for value in values]
        elif isinstance(stage, VectorAssembler) and stage.getOutputCol() == "numbers_raw":
            names += [f"numeric__{column}" for column in stage.getInputCols()]
    return names


def importance(fitted: PipelineModel, spark: SparkSession) -> DataFrame:
    """Feature names (category values included) and importances, largest first."""
    values = fitted.stages[-1].featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(feature_names(fitted), values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        largest_first("importance"), "feature"
    )


def draw_settings(
    space: Mapping[str, Sequence] = SEARCH_SPACE, draws: int = SEARCH_DRAWS, seed: int = SEED
) -> list[dict]:
    """Distinct random combinations of the search space."""
    every = [dict(zip(space, values)) for values in product(*space.values())]
    return random.Random(seed).sample(every, min(draws, len(every)))


def with_folds(train: DataFrame, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Add ``fold``: the rows of each class are dealt out in the order of their key hashes, so every fold has its share."""
    hashed = train.withColumn("__hash", key_hash(seed + 1))
    dealt = positions(hashed, [TARGET], [F.col("__hash"), F.col(KEY)], "__number")
    return dealt.withColumn("fold", ((F.col("__number") - 1) % folds).cast("int")).drop("__hash", "__number")


def search(
    train: DataFrame, settings: Sequence[Mapping], folds: int = FOLDS, seed: int = SEED, parallelism: int = 4, keep_models: bool = False
) -> tuple[CrossValidatorModel, list[Mapping]]:
    """Cross-validated search for the best F1; the best setting is refitted on all train rows.  ``keep_models`` keeps those of the folds."""
    folded = spread(with_folds(train, folds, seed), "folds")
    rows = folded.count()
    prepare = detached(estimator(without_weight(train), rows).fit(folded))
    if in_task(folded, prepare):
        return search_in_tasks(folded, settings, folds, seed, prepare, rows, keep_models), list(settings)
    model = forest()
    grid = [
        {
            model.numTrees: s["n_estimators"],
            model.maxDepth: s["max_depth"] or DEEPEST,
            model.minInstancesPerNode: s["min_samples_leaf"],
            model.featureSubsetStrategy: s["max_features"] or "all",
        }
        for s in settings
    ]
    validator = CrossValidator(
        estimator=estimator(without_weight(train), rows, model),
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol=TARGET, metricName="fMeasureByLabel", metricLabel=1.0),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
        collectSubModels=keep_models,
    )
    found = validator.fit(folded)
    of_folds = [[detached(model) for model in models] for models in found.subModels] if keep_models else None
    return CrossValidatorModel(detached(found.bestModel), found.avgMetrics, of_folds, found.stdMetrics), list(settings)


def search_in_tasks(folded: DataFrame, settings: Sequence[Mapping], folds: int, seed: int, prepare: PipelineModel, rows: int, keep_models: bool) -> CrossValidatorModel:
    """``search`` with the trees of all settings and folds in one job; preprocessing is fitted on the train rows of each fold."""
    own = [forests.Settings(s["n_estimators"], s["max_depth"] or DEEPEST, s["min_samples_leaf"], s["max_features"] or "all") for s in settings]
    fits = [(fold, s) for fold in range(folds) for s in own]
    plain = without_weight(folded).drop("fold")
    each = [detached(estimator(plain, rows).fit(folded.where(F.col("fold") != fold))) for fold in range(folds)]
    seen = [prepared.transform(folded).withColumn("__train", F.col("fold") != fold) for fold, prepared in enumerate(each)]
    trees, grown = grow_forests(seen, F.col("__train"), fits, seed, keep_models)
    f1 = forests.measured(trees, fits)
    f1 = np.array([f1[i] for i in range(len(fits))]).reshape(folds, len(own))
    of_folds = None
    if keep_models:
        of_folds = [[PipelineModel([*each[fold].stages, grown[fold * len(own) + i]]) for i in range(len(own))] for fold in range(folds)]
    average = f1.mean(axis=0)
    best = int(np.argmax(average))
    _, refitted = grow_forests([prepare.transform(folded)], F.lit(True), [(0, own[best])], seed)
    chosen = PipelineModel([*prepare.stages, refitted[0]])
    return CrossValidatorModel(chosen, average.tolist(), of_folds, f1.std(axis=0).tolist())


def search_table(found: CrossValidatorModel, settings: Sequence[Mapping], spark: SparkSession) -> DataFrame:
    """Every drawn setting with its mean F1, best first."""
    rows = [
        (s["n_estimators"], s["max_depth"], s["max_depth"] or DEEPEST, s["min_samples_leaf"], s["max_features"], float(f1))
        for s, f1 in zip(settings, found.avgMetrics)
    ]
    schema = "n_estimators int, max_depth int, grown_depth int, min_samples_leaf int, max_features string, cv_f1 double"
    return spark.createDataFrame(rows, schema).orderBy(largest_first("cv_f1"))


def fit_tuned(split_df: DataFrame, name: str = "RandomForest_tuned", settings: Sequence[Mapping] | None = None) -> tuple[Fitted, float]:
    """The winner of the search, scored on the test rows, and its mean F1 over the folds."""
    train, test = parts_of(split_df)
    found, _ = search(train, draw_settings() if settings is None else settings)
    return Fitted(name, found.bestModel, score(found.bestModel, test)), float(max(found.avgMetrics))


def model_comparison(split_df: DataFrame, trees: int = 300, settings: Sequence[Mapping] | None = None) -> DataFrame:
    """One row of test measures for each of the three models; ``best_cv_f1`` for the tuned one."""
    tuned, f1 = fit_tuned(split_df, settings=settings)
    rows = [fit_logistic(split_df), fit_forest(split_df, trees=trees), tuned]
    measures = union_all([fitted.metrics().withColumn("best_cv_f1", F.lit(f1 if fitted is tuned else None).cast("double")) for fitted in rows])
    return measures
