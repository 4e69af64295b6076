"""Movie files to clean tables, relation tables and business tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.casting import to_day, to_id, to_number
from gristmill.functions.measures import floor_to_ten, guarded_ratio
from gristmill.functions.nested import first_name, literal_items
from gristmill.functions.ordering import largest_first, smallest_first
from gristmill.operators import quality
from gristmill.operators.aggregates import keep_top_values, present_groups, sum_or_zero
from gristmill.operators.cleaning import drop_missing, fill_missing, keep_first, keep_valid
from gristmill.operators.joins import inner_join, pair_counts
from gristmill.operators.reshape import count_pivot, explode_literal, to_long

# Columns, measures and labels of the tables.
RAW_COLUMNS = (
    "id", "title", "release_date", "original_language", "runtime", "budget", "revenue", "popularity",
    "vote_average", "vote_count",
)
NUMERIC_COLUMNS = ("runtime", "budget", "revenue", "popularity", "vote_average", "vote_count")
CLEAN_COLUMNS = (
    "movie_id", "title", "release_date", "release_year", "original_language", "runtime", "budget", "revenue",
    "popularity", "vote_average", "vote_count",
)
BUSINESS_METRICS = ("movie_count", "avg_rating", "avg_vote_count", "avg_revenue", "avg_profit", "avg_roi")
TOP_KEYWORDS = 8
DIRECTOR = "Director"


def rules() -> dict[str, Column]:
    """What a stored movie must not look like."""
    vote = F.col("vote_average")
    return {
        "runtime <= 0": F.col("runtime") <= 0,
        "budget < 0": F.col("budget") < 0,
        "revenue < 0": F.col("revenue") < 0,
        "vote_average not in 0~10": (vote < 0) | (vote > 10),
    }


def typed_movies(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Selected columns with types, the key renamed and the release year derived.

    ``order`` names the columns that tell which of several rows of a key came first.
    """
    return raw.select(
        to_number(F.col("id")).alias("movie_id"),
        "title",
        to_day(F.col("release_date")).alias("release_date"),
        "original_language",
        *[to_number(F.col(c)).alias(c) for c in NUMERIC_COLUMNS],
        *order,
    ).withColumn("release_year", F.year("release_date"))


def complete_movies(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Typed rows with every required value, and ``unknown`` for a missing language."""
    required = drop_missing(typed_movies(raw, order), ["movie_id", "title", "release_date", "runtime"])
    return fill_missing(required, {"original_language": "unknown"})


def unique_movies(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Complete rows, the first of each movie."""
    return keep_first(complete_movies(raw, order), ["movie_id"], [F.col(c).asc() for c in order])


def movies_clean(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """One trustworthy row per movie, ready to be loaded."""
    valid = keep_valid(unique_movies(raw, order), rules())
    return valid.withColumns(
        {"movie_id": to_id(F.col("movie_id")), "release_year": to_id(F.col("release_year"))}
    ).select(*CLEAN_COLUMNS)


def movies_reduced(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rebuild for the relation tables when no clean table is stored: only key and title are required."""
    typed = typed_movies(raw, order).select(
        "movie_id", "title", "release_date", "vote_average", "vote_count", "release_year", *order
    )
    first = keep_first(drop_missing(typed, ["movie_id", "title"]), ["movie_id"], [F.col(c).asc() for c in order])
    return first.withColumn("movie_id", to_id(F.col("movie_id"))).drop(*order)


def load_gate(clean: DataFrame) -> DataFrame:
    """Checks on the clean table before it is stored."""
    return quality.load_gate(clean, *_gate())


def gated_write(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The clean table, written, and the same checks, taken in the pass that writes it."""
    return quality.gated_write(clean, *_gate())


def _gate() -> tuple:
    return "movie_id", ["movie_id", "title", "release_date"], {"runtime": F.col("runtime") <= 0}


def with_movie_id(raw: DataFrame) -> DataFrame:
    """Side files: ``id`` becomes a whole-number ``movie_id``; rows without one go."""
    named = raw.withColumnRenamed("id", "movie_id").withColumn("movie_id", to_number(F.col("movie_id")))
    return drop_missing(named, ["movie_id"]).withColumn("movie_id", to_id(F.col("movie_id")))


def one_per_movie(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """First row of each movie of a side file."""
    return keep_first(with_movie_id(raw), ["movie_id"], [F.col(c).asc() for c in order]).drop(*order)


def keywords_clean(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Movie and its first keyword.  Rows are reduced before any text is parsed."""
    first = one_per_movie(raw.select("id", "keywords", *order), order)
    items = literal_items(F.col("keywords"), {"name": "string"})
    return first.select("movie_id", first_name(items).alias("main_keyword"))


def movies_with_keyword(clean: DataFrame, keywords: DataFrame) -> DataFrame:
    """Clean movies with their keyword, profit, return and decade."""
    keyed = drop_missing(clean, ["movie_id"])
    return inner_join(keyed, keywords, ["movie_id"]).withColumns(
        {
            "profit": F.col("revenue") - F.col("budget"),
            "roi": guarded_ratio(F.col("revenue"), F.col("budget")),
            "release_decade": floor_to_ten(F.col("release_year")),
        }
    )


def high_rating_by_year(movies: DataFrame, rating: float = 7.0, votes: int = 100) -> DataFrame:
    """Well rated movies with enough votes, per release year."""
    reliable = movies.where((F.col("vote_average") >= rating) & (F.col("vote_count") >= votes))
    return (
        present_groups(reliable, ["release_year"])
        .groupBy("release_year")
        .agg(
            F.count("title").alias("high_rating_movie_count"),
            F.avg("vote_average").alias("avg_rating"),
            F.avg("vote_count").alias("avg_vote_count"),
        )
        .orderBy(largest_first("high_rating_movie_count"), smallest_first("release_year"))
    )


def year_summary(movies: DataFrame) -> DataFrame:
    """Movies, ratings, votes and revenue per release year."""
    return (
        present_groups(movies, ["release_year"])
        .groupBy("release_year")
        .agg(
            F.count("title").alias("movie_count"),
            F.avg("vote_average").alias("avg_rating"),
            F.avg("vote_count").alias("avg_vote_count"),
            F.avg("revenue").alias("avg_revenue"),
        )
    )


def busiest_years(movies: DataFrame, rows: int = 10) -> DataFrame:
    return year_summary(movies).orderBy(largest_first("movie_count"), smallest_first("release_year")).limit(rows)


def best_rated_years(movies: DataFrame, rows: int = 10) -> DataFrame:
    return year_summary(movies).orderBy(largest_first("avg_rating"), smallest_first("release_year")).limit(rows)


def top_keyword_movies(movies: DataFrame, k: int = TOP_KEYWORDS) -> DataFrame:
    """Movies with one of the most frequent keywords."""
    return keep_top_values(drop_missing(movies, ["main_keyword", "release_decade"]), "main_keyword", k)


def decade_keyword_pivot(movies: DataFrame, k: int = TOP_KEYWORDS) -> DataFrame:
    """Movies per decade and frequent keyword."""
    return count_pivot(movies, "release_decade", "main_keyword", "title", k)


def keyword_business(movies: DataFrame, k: int = TOP_KEYWORDS) -> DataFrame:
    """Six measures per frequent keyword.

    How frequent a keyword is comes out of the same aggregation, so the rows
    need not be filtered by a list of keywords first.
    """
    present = drop_missing(movies, ["main_keyword", "release_decade"])
    return (
        present.groupBy("main_keyword")
        .agg(
            F.count("*").alias("__rows"),
            F.count("title").alias("movie_count"),
            F.avg("vote_average").alias("avg_rating"),
            F.avg("vote_count").alias("avg_vote_count"),
            F.avg("revenue").alias("avg_revenue"),
            F.avg("profit").alias("avg_profit"),
            F.avg("roi").alias("avg_roi"),
        )
        .orderBy(largest_first("__rows"), smallest_first("main_keyword"))
        .limit(k)
        .drop("__rows")
        .orderBy(largest_first("movie_count"), smallest_first("main_keyword"))
    )


def keyword_business_long(movies: DataFrame, k: int = TOP_KEYWORDS) -> DataFrame:
    """The same measures, one per row."""
    return to_long(keyword_business(movies, k), ["main_keyword"], BUSINESS_METRICS)


def movie_keywords(keywords_one: DataFrame) -> DataFrame:
    """One row per movie and keyword."""
    fields = {"keyword_id": ("id", "bigint"), "keyword_name": ("name", "string")}
    return explode_literal(keywords_one, "movie_id", "keywords", fields, ["keyword_id", "keyword_name"])


def movie_cast(credits_one: DataFrame) -> DataFrame:
    """One row per movie and cast entry."""
    fields = {
        "actor_id": ("id", "bigint"),
        "actor_name": ("name", "string"),
        "character": ("character", "string"),
        "cast_order": ("order", "bigint"),
    }
    return explode_literal(credits_one, "movie_id", "cast", fields, ["actor_id", "actor_name"])


def movie_crew(credits_one: DataFrame) -> DataFrame:
    """One row per movie and crew role."""
    fields = {
        "crew_id": ("id", "bigint"),
        "crew_name": ("name", "string"),
        "department": ("department", "string"),
        "job": ("job", "string"),
    }
    return explode_literal(credits_one, "movie_id", "crew", fields, ["crew_id", "crew_name", "job"])


def directors(crew: DataFrame) -> DataFrame:
    return crew.where(F.col("job") == DIRECTOR)


def credits_keywords(credits_one: DataFrame, keywords_one: DataFrame) -> DataFrame:
    """Credits and keywords side by side; raises when either repeats a movie."""
    return inner_join(credits_one, keywords_one, ["movie_id"], unique_left=True, unique_right=True).select(
        "movie_id", "cast", "crew", "keywords"
    )


def top_keywords(keywords: DataFrame) -> DataFrame:
    """Movies per keyword, most frequent first."""
    return (
        keywords.groupBy("keyword_name")
        .agg(F.count_distinct("movie_id").alias("movie_count"))
        .orderBy(largest_first("movie_count"), smallest_first("keyword_name"))
    )


def keyword_rating_summary(keywords: DataFrame, clean: DataFrame, min_count: int = 20) -> DataFrame:
    """Average rating and votes of keywords that occur in enough movies."""
    rated = drop_missing(clean.select("movie_id", "vote_average", "vote_count"), ["vote_average"])
    return (
        keywords.select("movie_id", "keyword_name")
        .join(rated, "movie_id")
        .groupBy("keyword_name")
        .agg(
            F.count_distinct("movie_id").alias("movie_count"),
            F.avg("vote_average").alias("avg_vote_average"),
            sum_or_zero("vote_count").alias("total_vote_count"),
        )
        .where(F.col("movie_count") >= min_count)
        .orderBy(largest_first("avg_vote_average"), largest_first("movie_count"), smallest_first("keyword_name"))
    )


def actor_keyword_summary(cast: DataFrame, keywords: DataFrame, min_count: int = 3) -> DataFrame:
    """Actor and keyword pairs that share enough movies."""
    pairs = pair_counts(cast, keywords, "movie_id", "actor_name", "keyword_name", min_count, "movie_count")
    return pairs.orderBy(largest_first("movie_count"), smallest_first("actor_name"), smallest_first("keyword_name"))


def director_keyword_summary(crew: DataFrame, keywords: DataFrame, min_count: int = 2) -> DataFrame:
    """Director and keyword pairs that share enough movies."""
    named = directors(crew).select("movie_id", F.col("crew_name").alias("director_name"))
    pairs = pair_counts(named, keywords, "movie_id", "director_name", "keyword_name", min_count, "movie_count")
    return pairs.orderBy(largest_first("movie_count"), smallest_first("director_name"), smallest_first("keyword_name"))
