import datetime

import pytest
from pyspark.sql import functions as F

from gristmill.operators.joins import RepeatedKeyError
from gristmill.plans import charts, evaluation, exploration, modeling, movies, patients
from tests.conftest import rows

RAW = [
    ("512", "A", "1995-10-30", "en", "81", "30000000", "271828182", "1", "7.3", "5217"),
    ("512", "A again", "1995-10-30", "en", "82", "1", "1", "1", "5", "1"),
    ("1997-08-20", "B", "1", None, None, "/x.jpg", None, None, None, None),
    ("10", "C", "2001-02-03", None, "90", None, "0", "1", "6", "10"),
    ("11", "D", "2001-02-03", "fr", "0", "5", "5", "1", "6", "1"),
    ("12", "E", "2001-02-03", "fr", "90", "-5", "5", "1", "6", "1"),
    ("13", "F", "2001-02-03", "fr", "90", "5", "5", "1", "11", "1"),
    ("14", None, "2001-02-03", "fr", "90", "5", "5", "1", "6", "1"),
]
ORDER = ["row"]


@pytest.fixture(scope="module")
def raw(spark):
    schema = ", ".join(f"{c} string" for c in movies.RAW_COLUMNS)
    return spark.createDataFrame([(*r, i) for i, r in enumerate(RAW)], schema + ", row int")


def test_movies_clean(raw):
    clean = movies.movies_clean(raw, ORDER)
    assert clean.columns == list(movies.CLEAN_COLUMNS)
    assert rows(clean, "movie_id", "title", "release_year", "original_language", "budget", "revenue") == [
        (10, "C", 2001, "unknown", None, 0.0), (512, "A", 1995, "en", 30000000.0, 271828182.0),
    ]
    gate = dict(rows(movies.load_gate(clean)))
    assert gate.pop("row_count") == 2 and set(gate.values()) == {0}
    assert rows(movies.movies_reduced(raw, ORDER), "movie_id", "title")[-1] == (512, "A")


def test_keyword_business(spark, raw):
    keywords = spark.createDataFrame(
        [("512", "[{'id': 17, 'name': 'violin'}, {'id': 2, 'name': 'harbour'}]", 0), ("512", "[]", 1), ("10", "broken", 2), ("x", "[]", 3)],
        "id string, keywords string, row int",
    )
    table = movies.movies_with_keyword(movies.movies_clean(raw, ORDER), movies.keywords_clean(keywords, ORDER))
    assert rows(table, "movie_id", "main_keyword", "profit", "release_decade") == [
        (10, None, None, 2000), (512, "violin", 241828182.0, 1990),
    ]
    assert table.where("movie_id = 10").first()["roi"] is None
    assert rows(movies.keyword_business(table), "main_keyword", "movie_count", "avg_rating") == [("violin", 1, 7.3)]
    assert movies.keyword_business_long(table).count() == 6
    assert rows(movies.decade_keyword_pivot(table)) == [(1990, 1)]
    assert rows(movies.high_rating_by_year(table)) == [(1995, 1, 7.3, 5217.0)]


def test_relation_tables(spark):
    credits = spark.createDataFrame(
        [(1, "[{'id': 5, 'name': 'X', 'character': None, 'order': 0}, {'id': None, 'name': 'Y'}]",
          "[{'id': 7, 'name': 'M', 'department': 'D', 'job': 'Director'}, {'id': 8, 'name': 'N'}]")],
        "movie_id bigint, cast string, crew string",
    )
    assert rows(movies.movie_cast(credits)) == [(1, 5, "X", None, 0)]
    assert rows(movies.directors(movies.movie_crew(credits))) == [(1, 7, "M", "D", "Director")]
    keywords = spark.createDataFrame([(1, "[]"), (1, "[]")], "movie_id bigint, keywords string")
    with pytest.raises(RepeatedKeyError):
        movies.credits_keywords(credits, keywords)
    assert movies.credits_keywords(credits, keywords.limit(1)).columns == ["movie_id", "cast", "crew", "keywords"]


@pytest.fixture(scope="module")
def people(spark):
    data = [
        (1, 29, 0, 35.0, 0, 1, 1), (2, 30, 1, 35.0, 0, 1, 1), (3, 39, 1, 20.0, 1, 2, 1), (4, 40, 0, None, 0, 0, 0),
        (5, 45, 0, 22.0, 0, 0, 0), (6, 46, 0, 22.0, 0, 0, 0), (7, 47, 0, 21.0, 0, 0, None),
    ]
    return spark.createDataFrame(data, "id int, age int, gender int, bmi double, smoking int, genetic_risk int, diagnosis int")


def test_patients(people):
    # a missing BMI sorts first when descending, and a missing diagnosis is no cancer
    assert rows(patients.bmi_ranked(people), "id", "bmi_rank_all") == [(1, 2), (2, 2), (3, 7), (4, 1), (5, 4), (6, 4), (7, 6)]
    assert rows(patients.bmi_rank_slice(people, 3, 6), "id") == [(5,), (6,), (7,)]
    assert rows(patients.bmi_page(people, 2, 2), "id") == [(2,), (5,)]
    assert patients.labelled(people).where("id = 7").first()["diagnosis_label"] == "No Cancer"
    top = patients.top_of_group(people, 2)
    assert rows(top.where("diagnosis_label = 'Cancer'"), "id", "bmi_rank_in_group", "sample_row_num") == [(1, 1, 1), (2, 1, 2)]
    beside = patients.beside_group(people).where("id = 3").first()
    assert (beside["group_patient_count"], beside["group_avg_bmi"], beside["bmi_diff_from_group_avg"]) == (3, 30.0, -10.0)
    assert rows(patients.with_age_band(people), "age", "age_band")[:3] == [(29, 20), (30, 30), (39, 30)]
    assert rows(patients.age_band_cancer_ratio(people)) == [(20, 1, 1, 1.0), (30, 2, 2, 1.0), (40, 4, 0, 0.0)]


def week(day):
    return datetime.date(2024, 1, day)


@pytest.fixture(scope="module")
def weekly(spark):
    data = [
        (week(7), "Show", 1, 10_000_000, 3), (week(7), "SHOW ", 2, 10_000_000, 1), (week(7), "Show", 4, 5_000_000, 1),
        (week(14), "Show", 7, 50_000_000, 4), (week(7), "Film", 4, 9_999_999, 3), (week(14), "Film", None, 1, 9),
        (week(7), "No meta", 1, 1, 1), (week(7), "Bad �", 1, 1, 1), (week(7), None, 1, 1, 1),
    ]
    return spark.createDataFrame(
        data, "week date, show_title string, weekly_rank int, weekly_hours_viewed bigint, cumulative_weeks_in_top_10 int"
    )


@pytest.fixture(scope="module")
def titles(spark):
    data = [
        ("s1", " show", "TV Show", "TV Dramas, International TV Shows"), ("s2", "SHOW", "nan", ""), ("s3", "film", "Movie", "Dramas"),
        ("s4", "ÿ", "Movie", "Dramas"), ("s5", "bad �", "Movie", "nan"),
    ]
    return spark.createDataFrame(data, "show_id string, title string, type string, listed_in string")


def test_content_weeks_and_label(weekly, titles):
    content = charts.content_week(weekly, titles)
    measures = ("week_date", "title_clean", "type_clean", "weekly_rank_num", "weekly_hours_viewed_num")
    # equal hours of two seasons count once
    assert rows(content, *measures) == [
        (week(7), "film", "Movie", 4, 9_999_999), (week(7), "show", "TV Show", 1, 15_000_000),
        (week(14), "film", "Movie", None, 1), (week(14), "show", "TV Show", 7, 50_000_000),
    ]
    assert rows(charts.content_week_proof(content)) == [(4, 4, 0)]
    assert rows(charts.long_run_label(content), "title_clean", "max_cumulative_weeks", "long_run_flag") == [("film", 9, 1), ("show", 4, 1)]


def test_model_inputs(weekly, titles):
    safe, leakage = charts.model_input_safe(weekly, titles), charts.model_input_leakage(weekly, titles)
    got = {r["title_clean"]: r.asDict() for r in safe.collect()}
    # the film's second week has no rank and does not count here
    assert got["film"]["long_run_flag"] == 0 and got["show"]["long_run_flag"] == 1
    assert (got["show"]["first_week_date"], got["show"]["first_season"], got["show"]["initial_rank_bucket"]) == (week(7), "winter", "top_3")
    assert (got["film"]["initial_rank_bucket"], got["film"]["initial_hours_bucket"]) == ("rank_4_7", "low")
    assert got["show"]["primary_genre"] == "TV Dramas" and got["show"]["initial_hours_bucket"] == "medium"
    from gristmill.operators.quality import extra_columns

    assert extra_columns(leakage, safe) == ["best_rank", "max_cumulative_weeks", "weeks_in_top10"]
    assert rows(exploration.table_comparison(safe, leakage)) == [("leakage", 2, 2, 0.5), ("safe", 2, 2, 0.5)]
    assert rows(charts.class_balance(safe)) == [(0, 1, 50.0), (1, 1, 50.0)]


def test_mart(spark, weekly, titles):
    mart = charts.genre_mart(weekly, titles)
    # of two titles that normalise alike the smaller show_id counts: two genres for each of four rows
    assert mart.where("title_clean = 'show'").count() == 8
    assert rows(charts.mart_quality(mart)) == [(11, 1, 0, 1)]
    clean = charts.mart_clean(mart)
    assert rows(charts.mart_clean_counts(clean)) == [(10, 2, 3)]
    assert rows(charts.mart_grain(clean)) == [(week(7), "show", 6, 2), (week(14), "show", 2, 2)]


def test_rising_genres_compare_present_seasons(spark):
    data = [(datetime.date(2023, 4, 2), "spring", "a", "Drama", 1)] + [(datetime.date(2023, 10, 1), "fall", t, "Drama", 1) for t in "abc"]
    data += [(datetime.date(2023, 12, 3), "winter", "a", "Drama", 1), (datetime.date(2023, 1, 1), "winter", "b", "Drama", 2)]
    clean = spark.createDataFrame(data, "week_date date, season string, title_clean string, genre string, weekly_rank_num int")
    got = charts.rising_genres(clean)
    # January and December of one year are one winter, after fall
    assert rows(got, "season", "top10_row_count", "prev_top10_row_count", "count_change") == [("fall", 3, 1, 2), ("winter", 2, 3, -1)]


# Confusion counts published for a fixed test set of 84 rows, 25 of them positive.
GOLDEN = [
    (0.30, 47, 26, 4, 0.446809, 0.84, 0.583333), (0.40, 34, 16, 7, 0.529412, 0.72, 0.610169),
    (0.50, 26, 10, 9, 0.615385, 0.64, 0.627451), (0.60, 15, 2, 12, 0.866667, 0.52, 0.65), (0.70, 10, 0, 15, 1.0, 0.40, 0.571429),
]


def test_threshold_sweep_on_published_counts(spark):
    scores, cuts = [], [0.0, *[g[0] for g in GOLDEN], 1.1]
    tp = [25, *[25 - g[3] for g in GOLDEN], 0]
    fp = [59, *[g[2] for g in GOLDEN], 0]
    for i in range(len(cuts) - 1):
        middle = (cuts[i] + min(cuts[i + 1], 1.0)) / 2
        scores += [(middle, 1)] * (tp[i] - tp[i + 1]) + [(middle, 0)] * (fp[i] - fp[i + 1])
    assert len(scores) == 84
    df = spark.createDataFrame(scores, "p double, y int")
    for got, want in zip(evaluation.threshold_sweep(df, "y", "p").collect(), GOLDEN):
        assert (got["predicted_count"], got["false_positive"], got["false_negative"]) == want[1:4]
        assert [got[c] for c in ("precision", "recall", "f1")] == pytest.approx(want[4:], abs=1e-6)


def test_undefined_rates_are_zero(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "p double, y int")
    row = evaluation.threshold_sweep(df, "y", "p", [0.5]).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


@pytest.fixture(scope="module")
def model_input(spark):
    from gristmill.scratch import materialize

    df = spark.range(400).select(
        F.concat(F.lit("t"), "id").alias("title_clean"),
        F.concat(F.lit("T"), "id").alias("show_title"),
        F.when(F.col("id") % 3 == 0, "Movie").otherwise("TV Show").alias("type_clean"),
        F.concat(F.lit("g"), (F.col("id") % 5).cast("string")).alias("primary_genre"),
        F.to_date(F.lit("2024-01-07")).alias("first_week_date"),
        (F.col("id") * 37 % 10 + 1).cast("int").alias("first_week_rank"),
        ((F.col("id") * 7919) % 1000).alias("first_week_hours_viewed"),
        ((F.col("id") * 7919) % 1000 + F.col("id") * 31 % 600 > 1000).cast("int").alias("long_run_flag"),
    )
    return materialize(df, "model-input")


def test_split_is_stratified_and_stable(model_input):
    split = modeling.split(model_input)
    again = modeling.split(model_input.repartition(5))
    assert rows(split, "title_clean", "split") == rows(again, "title_clean", "split")
    for r in split.groupBy("long_run_flag").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
        assert r["t"] == int(r["n"] * 0.25 + 0.5)
    loose = modeling.split(model_input, exact=False).where("split = 'test'").count()
    assert 60 < loose < 140
    weights = dict(rows(modeling.class_weights(model_input).select("long_run_flag", F.col("class_weight") * F.col("class_rows"))))
    assert all(v == pytest.approx(200) for v in weights.values())


def test_models(spark, model_input):
    split = modeling.split(model_input)
    leaky = modeling.split(model_input.withColumn("max_cumulative_weeks", F.col("long_run_flag") * 4))
    compared = {r["model"]: r for r in modeling.leakage_comparison(split, leaky).collect()}
    assert compared["LogisticRegression_leakage"]["roc_auc"] > compared["LogisticRegression_safe"]["roc_auc"] > 0.6
    fitted = modeling.fit_forest(split, trees=10, depth=5)
    metrics = fitted.metrics().first()
    assert 0.5 < metrics["roc_auc"] <= 1 and fitted.scored.count() == split.where("split = 'test'").count()
    importance = modeling.importance(fitted.model, spark).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1)
    assert importance[0]["feature"] == "numeric__first_week_hours_viewed"
    assert {"categorical__type_clean_Movie", "categorical__primary_genre_g4"} <= {r["feature"] for r in importance}
    # a category that training never saw becomes all zeros
    strange = split.where("split = 'test'").withColumn("primary_genre", F.lit("new"))
    assert modeling.score(fitted.model, strange).count() > 0


def test_search(spark, model_input):
    settings = modeling.draw_settings()
    assert len(settings) == 10 and len({tuple(s.values()) for s in settings}) == 10 and settings == modeling.draw_settings()
    small = [{**s, "n_estimators": 3, "max_depth": 2 + i} for i, s in enumerate(settings[:2])]
    train, test = modeling.parts_of(modeling.split(model_input))
    found, tried = modeling.search(train, small)
    assert modeling.search_table(found, tried, spark).count() == 2
    scored = modeling.score(found.bestModel, test)
    output = evaluation.scored_output(scored, "long_run_probability", "actual", modeling.MODEL_VERSION)
    assert output.columns[-2:] == ["model_version", "threshold"] and output.count() == test.count()
