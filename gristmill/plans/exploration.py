"""First looks at a model input: how its columns relate to the label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.ordering import largest_first
from gristmill.operators import quality
from gristmill.operators.aggregates import correlations, correlations_with, supported_rate, value_shares
from gristmill.operators.joins import inner_join
from gristmill.operators.ordered import medians
from gristmill.scratch import materialize

TARGET = "long_run_flag"
NUMERIC_FEATURES = ("first_month_num", "first_week_rank", "first_week_hours_viewed")


def table_comparison(safe: DataFrame, leakage: DataFrame) -> DataFrame:
    """Rows, titles and label rate of both inputs; they may differ in columns only."""
    return quality.compare_tables({"safe": safe, "leakage": leakage}, "title_clean", TARGET)


def target_distribution(safe: DataFrame) -> DataFrame:
    return value_shares(safe, TARGET, "rows", "ratio").select(TARGET, "ratio").orderBy(largest_first("ratio"), TARGET)


def numeric_correlations(safe: DataFrame) -> DataFrame:
    return correlations(safe, [*NUMERIC_FEATURES, TARGET])


def label_correlations(safe: DataFrame) -> DataFrame:
    return correlations_with(safe, NUMERIC_FEATURES, TARGET, "corr_with_long_run_flag")


def rate_by(safe: DataFrame, group: str, min_count: int = 5) -> DataFrame:
    """Long-run rate per type, genre or bucket with enough titles."""
    return supported_rate(safe, group, "title_clean", TARGET, min_count)


def label_profile(safe: DataFrame) -> DataFrame:
    """Counts, means and medians of the first week per label."""
    safe = materialize(safe.select(TARGET, "title_clean", "first_week_rank", "first_week_hours_viewed"), "profile")
    means = safe.groupBy(TARGET).agg(
        F.count("title_clean").alias("content_count"),
        F.avg("first_week_rank").alias("avg_first_week_rank"),
        F.avg("first_week_hours_viewed").alias("avg_first_week_hours"),
    )
    middle = medians(safe, [TARGET], ["first_week_rank", "first_week_hours_viewed"]).withColumnRenamed(
        "median_first_week_hours_viewed", "median_first_week_hours"
    )
    return inner_join(means, middle, [TARGET]).select(
        TARGET, "content_count", "avg_first_week_rank", "median_first_week_rank", "avg_first_week_hours",
        "median_first_week_hours",
    ).orderBy(TARGET)
