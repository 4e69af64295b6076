"""Classification measures, threshold sweep, scored output and dashboard tables.

A scored table has one row per title with a probability and a 0/1 actual value.
Every measure comes from one aggregation pass over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.measures import ratio_or_zero
from gristmill.functions.ordering import largest_first, smallest_first
from gristmill.operators.ordered import area_under_curve

# Thresholds and columns of the scored tables.
THRESHOLDS = (0.30, 0.40, 0.50, 0.60, 0.70)
DASHBOARD_THRESHOLD = 0.50
META_COLUMNS = ("title_clean", "show_title", "type_clean", "primary_genre", "first_week_date")


def predicted_flag(score: str, threshold: float | Column) -> Column:
    """1 when the score reaches the threshold."""
    return (F.col(score) >= threshold).cast("int")


def _cells(predicted: Column, actual: Column) -> dict[str, Column]:
    return {
        "tn": F.count_if((actual == 0) & (predicted == 0)),
        "fp": F.count_if((actual == 0) & (predicted == 1)),
        "fn": F.count_if((actual == 1) & (predicted == 0)),
        "tp": F.count_if((actual == 1) & (predicted == 1)),
    }


def rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Accuracy, precision, recall and F1; a ratio without cases is 0."""
    return {
        "accuracy": ratio_or_zero(tp + tn, tn + fp + fn + tp),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def confusion(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    cells = _cells(F.col(predicted), F.col(actual))
    return scored.agg(*[column.alias(name) for name, column in cells.items()])


def metric_row(scored: DataFrame, model: str, actual: str, predicted: str, score: str) -> DataFrame:
    """One row: model, accuracy, precision, recall, F1 and exact ROC AUC."""
    counts = confusion(scored, actual, predicted)
    columns = rates(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    auc = area_under_curve(scored, score, actual).scalar()
    return counts.select(
        F.lit(model).alias("model"), *[c.alias(n) for n, c in columns.items()], auc.alias("roc_auc")
    )


def threshold_sweep(
    scored: DataFrame, actual: str, score: str, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Measures per threshold.  All thresholds are counted in the same pass; rows are never multiplied."""
    counted = []
    for i, threshold in enumerate(thresholds):
        for name, column in _cells(predicted_flag(score, threshold), F.col(actual)).items():
            counted.append(column.alias(f"{name}{i}"))
    entries = F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{n}{i}").alias(n) for n in ("tn", "fp", "fn", "tp")])
        for i, t in enumerate(thresholds)
    ])
    per_threshold = scored.agg(*counted).select(F.inline(entries))
    measures = rates(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    return per_threshold.select(
        "threshold",
        *[measures[n].alias(n) for n in ("precision", "recall", "f1")],
        F.col("fp").alias("false_positive"),
        F.col("fn").alias("false_negative"),
        (F.col("tp") + F.col("fp")).alias("predicted_count"),
    ).orderBy("threshold")


def scored_output(
    scored: DataFrame, score: str, actual: str, model_version: str, threshold: float = DASHBOARD_THRESHOLD
) -> DataFrame:
    """The table handed on: who, how likely, predicted, actual, by which model and threshold."""
    return scored.select(
        *META_COLUMNS,
        F.col(score).alias("long_run_probability"),
        predicted_flag(score, threshold).alias("predicted_long_run_flag"),
        F.col(actual).alias("actual_long_run_flag"),
        F.lit(model_version).alias("model_version"),
        F.lit(float(threshold)).alias("threshold"),
    )


def dashboard_summary(output: DataFrame, best_cv_f1: float | None = None) -> DataFrame:
    """Headline numbers of a scored output, one row; the search's best F1 is passed in when there was one."""
    cells = _cells(F.col("predicted_long_run_flag"), F.col("actual_long_run_flag"))
    counts = output.agg(F.avg("long_run_probability").alias("avg_probability"), *[c.alias(n) for n, c in cells.items()])
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    measures = rates(tn, fp, fn, tp)
    return counts.select(
        (tn + fp + fn + tp).alias("content_count"),
        "avg_probability",
        (tp + fp).alias("predicted_count"),
        (tp + fn).alias("actual_long_run_count"),
        *[measures[n].alias(n) for n in ("precision", "recall", "f1")],
        fp.alias("false_positive"),
        fn.alias("false_negative"),
        *([F.lit(best_cv_f1).alias("best_cv_f1")] if best_cv_f1 is not None else []),
    )


def top_candidates(output: DataFrame, rows: int = 12) -> DataFrame:
    """Highest probabilities first."""
    return (
        output.orderBy(largest_first("long_run_probability"), smallest_first("title_clean"))
        .limit(rows)
        .drop("model_version", "threshold")
    )


def by_type(output: DataFrame) -> DataFrame:
    """Titles, mean probability and predicted titles per type."""
    return (
        output.groupBy("type_clean")
        .agg(
            F.count("*").alias("content_count"),
            F.avg("long_run_probability").alias("avg_probability"),
            F.sum("predicted_long_run_flag").alias("predicted_count"),
        )
        .orderBy(largest_first("avg_probability"), "type_clean")
    )


def by_genre(output: DataFrame, min_count: int = 2, rows: int = 8) -> DataFrame:
    """Mean probability of genres with enough titles, highest first."""
    return (
        output.groupBy("primary_genre")
        .agg(F.count("*").alias("content_count"), F.avg("long_run_probability").alias("avg_probability"))
        .where(F.col("content_count") >= min_count)
        .orderBy(largest_first("avg_probability"), "primary_genre")
        .limit(rows)
    )
