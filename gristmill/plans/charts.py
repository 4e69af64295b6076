"""Weekly chart and title metadata to genre reports, content weeks, labels and model inputs.

Weekly rows: week, show_title, weekly_rank, weekly_hours_viewed,
cumulative_weeks_in_top_10.  Titles: show_id, title, type, listed_in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.measures import bucket, flag, season_of, season_order
from gristmill.functions.ordering import smallest_first, sql_asc, sql_desc
from gristmill.functions.text import (
    DAMAGE_MARKS, REPLACEMENT_MARK, first_item, is_intact, join_key, list_items, sentinel_to_null,
)
from gristmill.operators import quality
from gristmill.operators.aggregates import value_shares
from gristmill.operators.cleaning import drop_missing, keep_first
from gristmill.operators.windows import neighbours

LONG_RUN_WEEKS = 4
HINDSIGHT_COLUMNS = ("weeks_in_top10", "best_rank", "max_cumulative_weeks")
MEASURES = ("weekly_rank_num", "weekly_hours_viewed_num", "cumulative_weeks_in_top_10_num")
MART_COLUMNS = (
    "week_date", "month_num", "season", "title_clean", "show_title", *MEASURES, "type_clean", "genre",
)
SAFE_COLUMNS = (
    "title_clean", "show_title", "type_clean", "primary_genre", "first_week_date", "first_season",
    "first_month_num", "first_week_rank", "first_week_hours_viewed", "initial_rank_bucket",
    "initial_hours_bucket", "long_run_flag",
)


def weekly_source(weekly: DataFrame) -> DataFrame:
    """Weekly rows with an undamaged title, under the names used downstream."""
    return weekly.where(is_intact(F.col("show_title"))).select(
        F.col("week").alias("week_date"),
        join_key(F.col("show_title")).alias("title_clean"),
        "show_title",
        F.col("weekly_rank").alias("weekly_rank_num"),
        F.col("weekly_hours_viewed").alias("weekly_hours_viewed_num"),
        F.col("cumulative_weeks_in_top_10").alias("cumulative_weeks_in_top_10_num"),
    )


def content_week_base(source: DataFrame) -> DataFrame:
    """One row per week and title.

    Several seasons of a show can chart in one week; equal hours among them
    count once, on purpose.
    """
    return source.groupBy("week_date", "title_clean").agg(
        F.min("show_title").alias("show_title"),
        F.min("weekly_rank_num").alias("weekly_rank_num"),
        F.sum_distinct("weekly_hours_viewed_num").alias("weekly_hours_viewed_num"),
        F.max("cumulative_weeks_in_top_10_num").alias("cumulative_weeks_in_top_10_num"),
    )


def title_features(titles: DataFrame) -> DataFrame:
    """Type and first listed genre per normalised title."""
    return (
        titles.where(is_intact(F.col("title"), DAMAGE_MARKS))
        .groupBy(join_key(F.col("title")).alias("title_clean"))
        .agg(
            F.min(sentinel_to_null(F.col("type"))).alias("type_clean"),
            F.min(first_item(F.col("listed_in"))).alias("primary_genre"),
        )
    )


def genre_mart(weekly: DataFrame, titles: DataFrame) -> DataFrame:
    """Weekly rows with type, one row per genre of the title.

    Grain: week, title and genre, repeated when several seasons chart at once.
    Of titles that normalise alike, the one with the smallest ``show_id`` counts.
    """
    dimension = titles.where(F.col("title").isNotNull()).select(
        join_key(F.col("title")).alias("title_clean"), F.col("type").alias("type_clean"), "listed_in", "show_id"
    )
    one = keep_first(dimension, ["title_clean"], [smallest_first("show_id")]).drop("show_id")
    named = weekly.where(F.col("show_title").isNotNull()).select(
        F.col("week").alias("week_date"),
        F.month("week").alias("month_num"),
        season_of(F.col("week")).alias("season"),
        join_key(F.col("show_title")).alias("title_clean"),
        "show_title",
        F.col("weekly_rank").alias("weekly_rank_num"),
        F.col("weekly_hours_viewed").alias("weekly_hours_viewed_num"),
        F.col("cumulative_weeks_in_top_10").alias("cumulative_weeks_in_top_10_num"),
    )
    joined = named.join(one, "title_clean")
    return joined.withColumn("genre", F.explode(list_items(F.col("listed_in")))).select(*MART_COLUMNS)


def mart_preview(mart: DataFrame, rows: int = 20) -> DataFrame:
    """First look at the mart, in a fixed order."""
    order = ["week_date", "title_clean", "genre", "show_title", "weekly_rank_num", "weekly_hours_viewed_num"]
    columns = [c for c in MART_COLUMNS if c != "month_num"]
    return mart.select(*columns).orderBy(*order, "cumulative_weeks_in_top_10_num").limit(rows)


def mart_quality(mart: DataFrame) -> DataFrame:
    """Rows, missing genres and types spelled ``nan``, and damaged titles."""
    damaged = F.col("title_clean").contains(REPLACEMENT_MARK) | F.col("show_title").contains(REPLACEMENT_MARK)
    return quality.conditional_counts(
        mart,
        {
            "genre_nan_rows": F.col("genre") == "nan",
            "type_nan_rows": F.col("type_clean") == "nan",
            "broken_title_rows": damaged,
        },
    )


def mart_clean(mart: DataFrame) -> DataFrame:
    """The mart without damaged titles and without missing types and genres."""
    kept = mart.where(is_intact(F.col("title_clean")) & is_intact(F.col("show_title")))
    nulled = kept.withColumns(
        {"type_clean": sentinel_to_null(F.col("type_clean")), "genre": sentinel_to_null(F.col("genre"))}
    )
    return drop_missing(nulled, ["type_clean", "genre"]).select(*MART_COLUMNS)


def mart_clean_counts(clean: DataFrame) -> DataFrame:
    """Rows, titles and genres after cleaning.  Folded per (title, genre) before the distinct counts."""
    folded = clean.groupBy("title_clean", "genre").agg(F.count("*").alias("n"))
    return folded.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("clean_rows"),
        F.count_distinct("title_clean").alias("clean_title_count"),
        F.count_distinct("genre").alias("clean_genre_count"),
    )


def mart_latest(clean: DataFrame, rows: int = 30) -> DataFrame:
    """Latest weeks first, to see what one row stands for."""
    columns = ["week_date", "title_clean", "show_title", "genre", "weekly_rank_num", "weekly_hours_viewed_num"]
    order = [sql_desc("week_date"), sql_asc("weekly_rank_num"), "title_clean", "genre", "show_title",
             sql_asc("weekly_hours_viewed_num")]
    return clean.select(*columns).orderBy(*order).limit(rows)


def mart_grain(clean: DataFrame, rows: int = 20) -> DataFrame:
    """Weeks and titles that cover several mart rows."""
    repeats = quality.grain_repeats(clean, ["week_date", "title_clean"], "genre", "row_count", "genre_count")
    return repeats.orderBy(F.desc("row_count"), sql_desc("week_date"), "title_clean").limit(rows)


def _charted(clean: DataFrame, keys: Sequence[str | Column], hours: bool = True) -> DataFrame:
    """Chart rows, titles and averages per group, unrounded averages kept for ranking."""
    measures = [
        F.count("*").alias("top10_row_count"),
        F.count_distinct("title_clean").alias("title_count"),
        F.avg("weekly_rank_num").alias("__avg_rank"),
        F.round(F.avg("weekly_rank_num"), 2).alias("avg_rank"),
    ]
    if hours:
        measures.append(F.round(F.avg("weekly_hours_viewed_num"), 0).alias("avg_hours_viewed"))
    return clean.groupBy(*keys).agg(*measures)


def genre_frequency(clean: DataFrame, rows: int = 20) -> DataFrame:
    """Which genres chart most."""
    summary = _charted(clean, ["genre"]).drop("__avg_rank")
    return summary.orderBy(F.desc("top10_row_count"), sql_asc("avg_rank"), "genre").limit(rows)


def season_genre_rank(clean: DataFrame) -> DataFrame:
    """Genres of each season by chart rows, better average rank first on ties.

    The window runs over one row per season and genre.
    """
    order = [F.desc("top10_row_count"), sql_asc("__avg_rank")]
    ranked = F.rank().over(Window.partitionBy("season").orderBy(*order)).cast("bigint").alias("genre_rank_in_season")
    return _charted(clean, ["season", "genre"]).select("*", ranked).drop("__avg_rank")


def season_genre_top(clean: DataFrame, rows: int = 40) -> DataFrame:
    return season_genre_rank(clean).orderBy("season", "genre_rank_in_season", "genre").limit(rows)


def season_genre_summary(clean: DataFrame) -> DataFrame:
    """Chart rows per year, season and genre."""
    dated = clean.withColumns({"year_num": F.year("week_date"), "season_order": season_order(F.col("season"))})
    keys = ["year_num", "season", "season_order", "genre"]
    return _charted(dated, keys, hours=False).drop("__avg_rank")


def season_genre_change(clean: DataFrame) -> DataFrame:
    """The summary with the genre's previous present season beside it."""
    order = ["year_num", "season_order"]
    return neighbours(
        season_genre_summary(clean), ["genre"], [sql_asc(c) for c in order], "top10_row_count",
        previous="prev_top10_row_count",
    )


def rising_genres(clean: DataFrame, rows: int = 30) -> DataFrame:
    """Genres that gained most chart rows since their previous season."""
    change = F.col("top10_row_count") - F.col("prev_top10_row_count")
    return (
        season_genre_change(clean)
        .where(F.col("prev_top10_row_count").isNotNull())
        .select(
            "year_num", "season", "genre", "top10_row_count", "prev_top10_row_count",
            change.alias("count_change"), "title_count", "avg_rank",
        )
        .orderBy(F.desc("count_change"), F.desc("top10_row_count"), "year_num", "season", "genre")
        .limit(rows)
    )


def content_week(weekly: DataFrame, titles: DataFrame) -> DataFrame:
    """Weekly performance per title with its type; titles without metadata drop out."""
    base = content_week_base(weekly_source(weekly))
    features = title_features(titles).select("title_clean", "type_clean")
    return base.join(features, "title_clean").select(
        "week_date", "title_clean", "show_title", "type_clean", *MEASURES
    )


def content_week_latest(content: DataFrame, rows: int = 30) -> DataFrame:
    return content.orderBy(sql_desc("week_date"), sql_asc("weekly_rank_num"), "title_clean").limit(rows)


def content_week_proof(content: DataFrame) -> DataFrame:
    """Shows that week and title are unique."""
    names = ("content_week_rows", "distinct_content_week_rows", "duplicate_content_week_rows")
    return quality.grain_proof(content, ["week_date", "title_clean"], names)


def content_week_matches(content: DataFrame) -> DataFrame:
    """Rows with a known type."""
    return quality.conditional_counts(
        content, {"matched_type_rows": F.col("type_clean").isNotNull()}, "content_week_rows"
    )


def long_run_label(content: DataFrame) -> DataFrame:
    """Per title: weeks, best rank, longest stay, and whether it stayed long."""
    return content.groupBy("title_clean", "type_clean").agg(
        F.min("show_title").alias("show_title"),
        F.count_distinct("week_date").alias("weeks_in_top10"),
        F.min("weekly_rank_num").alias("best_rank"),
        F.max("cumulative_weeks_in_top_10_num").alias("max_cumulative_weeks"),
        flag(F.max("cumulative_weeks_in_top_10_num") >= LONG_RUN_WEEKS).alias("long_run_flag"),
    ).select("title_clean", "show_title", "type_clean", *HINDSIGHT_COLUMNS, "long_run_flag")


def longest_runs(content: DataFrame, rows: int = 30) -> DataFrame:
    order = [sql_desc("max_cumulative_weeks"), sql_asc("best_rank"), "title_clean"]
    return long_run_label(content).orderBy(*order).limit(rows)


def model_input_leakage(weekly: DataFrame, titles: DataFrame) -> DataFrame:
    """Features of the first chart week, the label, and three columns known only in hindsight.

    Unlike the content weeks, rows without rank, hours or stay do not count
    here.  First week and whole-run summary come out of one aggregation per
    title: (week, title) is unique, so rows are weeks.
    """
    source = drop_missing(weekly_source(weekly), MEASURES)
    base = content_week_base(source)
    first = F.struct("week_date", "weekly_rank_num", "show_title", "weekly_hours_viewed_num")
    run = base.groupBy("title_clean").agg(
        F.min(first).alias("first"),
        F.count("*").alias("weeks_in_top10"),
        F.min("weekly_rank_num").alias("best_rank"),
        F.max("cumulative_weeks_in_top_10_num").alias("max_cumulative_weeks"),
    )
    day, rank, hours = F.col("first.week_date"), F.col("first.weekly_rank_num"), F.col("first.weekly_hours_viewed_num")
    features = drop_missing(title_features(titles), ["type_clean", "primary_genre"])
    return run.join(features, "title_clean").select(
        "title_clean",
        F.col("first.show_title").alias("show_title"),
        "type_clean",
        "primary_genre",
        day.alias("first_week_date"),
        season_of(day).alias("first_season"),
        F.month(day).alias("first_month_num"),
        rank.alias("first_week_rank"),
        hours.alias("first_week_hours_viewed"),
        bucket([(rank <= 3, "top_3"), (rank <= 7, "rank_4_7")], "rank_8_10").alias("initial_rank_bucket"),
        bucket([(hours >= 50_000_000, "high"), (hours >= 10_000_000, "medium")], "low").alias("initial_hours_bucket"),
        flag(F.col("max_cumulative_weeks") >= LONG_RUN_WEEKS).alias("long_run_flag"),
        *HINDSIGHT_COLUMNS,
    )


def model_input_safe(weekly: DataFrame, titles: DataFrame) -> DataFrame:
    """Only what is known in the first chart week, and the label."""
    return model_input_leakage(weekly, titles).select(*SAFE_COLUMNS)


def model_input_preview(safe: DataFrame, rows: int = 20) -> DataFrame:
    return safe.orderBy(sql_desc("first_week_date"), sql_asc("first_week_rank"), "title_clean").limit(rows)


def class_balance(safe: DataFrame) -> DataFrame:
    """Rows and percentage per label."""
    shares = value_shares(safe, "long_run_flag", "content_count", "__pct", 100.0)
    return shares.select(
        "long_run_flag", "content_count", F.round(F.col("__pct"), 2).cast("double").alias("content_ratio_pct")
    ).orderBy("long_run_flag")
