"""Movie plans over order lines: one order is a movie, its lines are repeated raw rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.bindings import KEYWORDS, KEYWORD_NAME, KEYWORD_NO, LINE_ORDER, feed, table
from checks.registry import query, rounded, with_sql
from gristmill.functions.nested import first_name, literal_items
from gristmill.operators import quality
from gristmill.operators.aggregates import top_values, value_counts
from gristmill.operators.joins import join_report
from gristmill.plans import movies

ORDER_SQL = ", ".join(LINE_ORDER)
TYPED = """typed AS (
  SELECT TRY_CAST(id AS DOUBLE) AS movie_id, title, TRY_CAST(CASE WHEN length(release_date) = 10 THEN release_date END AS DATE)
    AS release_date, original_language, TRY_CAST(runtime AS DOUBLE) AS runtime, TRY_CAST(budget AS DOUBLE) AS budget,
    TRY_CAST(revenue AS DOUBLE) AS revenue, TRY_CAST(popularity AS DOUBLE) AS popularity,
    TRY_CAST(vote_average AS DOUBLE) AS vote_average, TRY_CAST(vote_count AS DOUBLE) AS vote_count,
    line_no, part_no, supp_no, ship_day, CAST(year(TRY_CAST(CASE WHEN length(release_date) = 10 THEN release_date END AS DATE)) AS INTEGER) AS release_year
  FROM raw_movies)"""
COMPLETE = """complete AS (
  SELECT * REPLACE (coalesce(original_language, 'unknown') AS original_language) FROM typed
  WHERE movie_id IS NOT NULL AND title IS NOT NULL AND release_date IS NOT NULL AND runtime IS NOT NULL)"""
UNIQUE = f"""first_rows AS (
  SELECT * FROM complete QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY {ORDER_SQL}) = 1)"""
CLEAN = """clean AS (
  SELECT CAST(movie_id AS BIGINT) AS movie_id, title, release_date, CAST(release_year AS BIGINT) AS release_year,
    original_language, runtime, budget, revenue, popularity, vote_average, vote_count
  FROM first_rows
  WHERE NOT coalesce(runtime <= 0, false) AND NOT coalesce(budget < 0, false) AND NOT coalesce(revenue < 0, false)
    AND NOT coalesce(vote_average < 0 OR vote_average > 10, false))"""
CLEAN_CTES = ("raw_movies", TYPED, COMPLETE, UNIQUE, CLEAN)
# Side files straight from the order lines: what the literal text spells, without parsing it.
LINES = f"""lines AS (
  SELECT l.*, {KEYWORD_NO} AS kw_no, CASE WHEN l_linenumber < 7 THEN {KEYWORD_NAME} END AS kw_name
  FROM lineitem l WHERE NOT (l_returnflag = 'R' AND l_tax = 0.08)
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE)) = 1)"""
HAS_KEYWORDS = "l_tax NOT IN (0.07, 0.08) AND l_discount NOT IN (0.09, 0.1)"
MAIN_KEYWORD = f"""keywords_clean AS (
  SELECT l_orderkey AS movie_id, CASE WHEN {HAS_KEYWORDS} THEN kw_name END AS main_keyword FROM lines)"""
WITH_KEYWORD = """with_keyword AS (
  SELECT c.*, k.main_keyword, revenue - budget AS profit, CASE WHEN budget > 0 THEN revenue / budget END AS roi,
    CAST(floor(release_year / 10) * 10 AS BIGINT) AS release_decade
  FROM clean c JOIN keywords_clean k USING (movie_id))"""
KEYWORD_CTES = (*CLEAN_CTES, LINES, MAIN_KEYWORD, WITH_KEYWORD)
TOP_EIGHT = """top_eight AS (
  SELECT main_keyword FROM with_keyword WHERE main_keyword IS NOT NULL AND release_decade IS NOT NULL
  GROUP BY main_keyword ORDER BY count(*) DESC, main_keyword LIMIT 8)"""
MOVIE_KEYWORDS = f"""movie_keywords AS (
  SELECT l_orderkey AS movie_id, CAST(kw_no AS BIGINT) AS keyword_id, kw_name AS keyword_name
  FROM lines WHERE {HAS_KEYWORDS} AND kw_name IS NOT NULL
  UNION ALL
  SELECT l_orderkey, 100 + l_suppkey, 'supplier ' || l_suppkey || '''s' FROM lines WHERE {HAS_KEYWORDS})"""
MOVIE_CAST = """movie_cast AS (
  SELECT l_orderkey AS movie_id, l_suppkey AS actor_id, 'Actor ' || l_suppkey AS actor_name,
    CAST(NULL AS VARCHAR) AS character, CAST(0 AS BIGINT) AS cast_order FROM lines WHERE l_tax <> 0.06
  UNION ALL
  SELECT l_orderkey, l_partkey, 'Star ' || l_partkey || '''s', 'Line ' || l_linenumber, 1 FROM lines WHERE l_tax <> 0.06)"""
MOVIE_CREW = """movie_crew AS (
  SELECT l_orderkey AS movie_id, l_suppkey AS crew_id, 'Maker ' || l_suppkey AS crew_name, 'Directing' AS department,
    'Director' AS job FROM lines WHERE l_tax <> 0.05
  UNION ALL
  SELECT l_orderkey, l_partkey, 'Writer ' || l_partkey, NULL, 'Writer' FROM lines WHERE l_tax <> 0.05)"""


def raw(spark, d):
    return feed(spark, d, "raw_movies")


def clean(spark, d):
    return movies.movies_clean(raw(spark, d), LINE_ORDER)


def keywords_one(spark, d):
    return movies.one_per_movie(feed(spark, d, "raw_keywords"), LINE_ORDER)


def credits_one(spark, d):
    return movies.one_per_movie(feed(spark, d, "raw_credits"), LINE_ORDER)


def with_keyword(spark, d):
    return movies.movies_with_keyword(clean(spark, d), movies.keywords_clean(feed(spark, d, "raw_keywords"), LINE_ORDER))


@query("column_profile", with_sql("raw_movies", select="""
SELECT column_name, 'string' AS dtype, missing_count, round_even(missing_count * 100.0 / n, 2) AS missing_ratio FROM (
  SELECT count(*) AS n, """ + ", ".join(f"count(*) - count({c}) AS {c}" for c in movies.RAW_COLUMNS) + """ FROM raw_movies)
UNPIVOT (missing_count FOR column_name IN (""" + ", ".join(movies.RAW_COLUMNS) + "))"))
def column_profile(spark, d):
    return quality.missing_profile(raw(spark, d), movies.RAW_COLUMNS)


TYPED_COLUMNS = [c for c in movies.CLEAN_COLUMNS]


@query("missing_profile", with_sql("raw_movies", TYPED, select="""
SELECT column_name, missing_count, round_even(missing_count * 100.0 / n, 2) AS missing_ratio FROM (
  SELECT count(*) AS n, """ + ", ".join(f"count(*) - count({c}) AS {c}" for c in TYPED_COLUMNS) + """ FROM typed)
UNPIVOT (missing_count FOR column_name IN (""" + ", ".join(TYPED_COLUMNS) + "))"))
def missing_profile(spark, d):
    return quality.missing_worst_first(movies.typed_movies(raw(spark, d)), TYPED_COLUMNS)


@query("duplicate_report", with_sql("raw_movies", TYPED, COMPLETE, select="""
SELECT CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows,
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeat_rows
FROM (SELECT count(*) AS n FROM complete GROUP BY movie_id)"""))
def duplicate_report(spark, d):
    return quality.duplicate_rows(movies.complete_movies(raw(spark, d), LINE_ORDER), ["movie_id"])


@query("duplicate_sample", with_sql("raw_movies", TYPED, COMPLETE, select="""
SELECT movie_id, title, release_date FROM (
  SELECT *, count(*) OVER (PARTITION BY movie_id) AS n FROM complete)
WHERE n > 1 ORDER BY movie_id, title, release_date LIMIT 10"""))
def duplicate_sample(spark, d):
    complete = movies.complete_movies(raw(spark, d), LINE_ORDER)
    return quality.duplicate_sample(complete, ["movie_id"], ["movie_id", "title", "release_date"])


@query("duplicated_line_keys", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""")
def duplicated_line_keys(spark, d):
    from gristmill.operators.cleaning import rows_of_duplicated_keys

    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows_of_duplicated_keys(lines, ["l_orderkey", "l_linenumber"])


@query("rule_violations", with_sql("raw_movies", TYPED, COMPLETE, UNIQUE, select="""
SELECT 'runtime <= 0' AS rule, count(*) FILTER (WHERE runtime <= 0) AS violations FROM first_rows
UNION ALL SELECT 'budget < 0', count(*) FILTER (WHERE budget < 0) FROM first_rows
UNION ALL SELECT 'revenue < 0', count(*) FILTER (WHERE revenue < 0) FROM first_rows
UNION ALL SELECT 'vote_average not in 0~10', count(*) FILTER (WHERE vote_average < 0 OR vote_average > 10) FROM first_rows"""))
def rule_violations(spark, d):
    return quality.rule_violations(movies.unique_movies(raw(spark, d), LINE_ORDER), movies.rules())


@query("movies_clean", with_sql(*CLEAN_CTES, select="SELECT * FROM clean"))
def movies_clean(spark, d):
    return clean(spark, d)


@query("movies_reduced", with_sql("raw_movies", TYPED, select=f"""
SELECT CAST(movie_id AS BIGINT) AS movie_id, title, release_date, vote_average, vote_count, release_year
FROM typed WHERE movie_id IS NOT NULL AND title IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY {ORDER_SQL}) = 1"""))
def movies_reduced(spark, d):
    return movies.movies_reduced(raw(spark, d), LINE_ORDER)


GATE_SQL = with_sql(*CLEAN_CTES, select="""
SELECT 'row_count' AS "check", count(*) AS value FROM clean
UNION ALL SELECT 'duplicate_movie_id', count(*) - count(DISTINCT movie_id) FROM clean
UNION ALL SELECT 'missing_movie_id', count(*) - count(movie_id) FROM clean
UNION ALL SELECT 'missing_title', count(*) - count(title) FROM clean
UNION ALL SELECT 'missing_release_date', count(*) - count(release_date) FROM clean
UNION ALL SELECT 'invalid_runtime', count(*) FILTER (WHERE runtime <= 0) FROM clean""")


@query("preload_gate", GATE_SQL)
def preload_gate(spark, d):
    return movies.load_gate(clean(spark, d))


@query("gated_write", GATE_SQL)
def gated_write(spark, d):
    return movies.gated_write(clean(spark, d))[1]


@query("first_item", with_sql(LINES, MAIN_KEYWORD, select="SELECT * FROM keywords_clean"))
def first_item(spark, d):
    return movies.keywords_clean(feed(spark, d, "raw_keywords"), LINE_ORDER)


@query("first_item_every_line", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN {HAS_KEYWORDS} AND l_linenumber < 7 THEN {KEYWORD_NAME} END AS main_keyword,
  CASE WHEN {HAS_KEYWORDS} THEN 2 ELSE 0 END AS items FROM lineitem""")
def first_item_every_line(spark, d):
    items = literal_items(F.col("keywords"), {"id": "bigint", "name": "string"})
    lines = table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", *_keyword_text())
    parsed = lines.withColumn("parsed", items)
    return parsed.select(
        "l_orderkey", "l_linenumber", first_name(F.col("parsed")).alias("main_keyword"), F.size("parsed").alias("items")
    )


def _keyword_text():
    from checks.bindings import FEEDS

    return [e for e in FEEDS["raw_keywords"][1] if e.endswith("AS keywords")]


@query("join_report", with_sql(*CLEAN_CTES, LINES, MAIN_KEYWORD, select="""
SELECT (SELECT count(*) FROM clean) AS left_rows, (SELECT count(*) FROM keywords_clean) AS right_rows,
  (SELECT count(*) - count(DISTINCT movie_id) FROM clean) AS left_repeats,
  (SELECT count(*) - count(DISTINCT movie_id) FROM keywords_clean) AS right_repeats,
  count(*) AS joined_rows, count(*) - count(DISTINCT movie_id) AS joined_repeats,
  count(*) - count(main_keyword) AS joined_missing, 'bigint' AS left_key_types, 'bigint' AS right_key_types
FROM clean JOIN keywords_clean USING (movie_id)"""))
def join_report_movies(spark, d):
    keywords = movies.keywords_clean(feed(spark, d, "raw_keywords"), LINE_ORDER)
    return join_report(clean(spark, d), keywords, ["movie_id"], "main_keyword")


@query("join_report_repeated", """
SELECT (SELECT count(*) FROM orders) AS left_rows, (SELECT count(*) FROM lineitem) AS right_rows,
  (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) AS left_repeats,
  (SELECT count(*) - count(DISTINCT l_orderkey) FROM lineitem) AS right_repeats,
  count(*) AS joined_rows, count(*) - count(DISTINCT o_orderkey) AS joined_repeats,
  count(*) FILTER (WHERE l_discount = 0) AS joined_missing, 'bigint' AS left_key_types, 'bigint' AS right_key_types
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def join_report_repeated(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"))
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("discount")
    )
    return join_report(orders, lines, ["order_id"], "discount")


@query("movies_with_keyword", with_sql(*KEYWORD_CTES, select="SELECT * FROM with_keyword"))
def movies_with_keyword(spark, d):
    return with_keyword(spark, d)


@query("high_rating_by_year", with_sql(*KEYWORD_CTES, select="""
SELECT release_year, count(title) AS high_rating_movie_count, round(avg(vote_average), 6) AS avg_rating,
  round(avg(vote_count), 6) AS avg_vote_count
FROM with_keyword WHERE vote_average >= 7 AND vote_count >= 100 GROUP BY release_year"""))
def high_rating_by_year(spark, d):
    return rounded(movies.high_rating_by_year(with_keyword(spark, d)), "avg_rating", "avg_vote_count")


YEAR_SQL = """
SELECT release_year, count(title) AS movie_count, round(avg(vote_average), 6) AS avg_rating,
  round(avg(vote_count), 6) AS avg_vote_count, round(avg(revenue), 6) AS avg_revenue
FROM with_keyword WHERE release_year IS NOT NULL GROUP BY release_year"""
YEAR_MEANS = ("avg_rating", "avg_vote_count", "avg_revenue")


@query("year_summary", with_sql(*KEYWORD_CTES, select=YEAR_SQL))
def year_summary(spark, d):
    return rounded(movies.year_summary(with_keyword(spark, d)), *YEAR_MEANS)


@query("busiest_years", with_sql(*KEYWORD_CTES, select=YEAR_SQL + " ORDER BY movie_count DESC, release_year LIMIT 10"))
def busiest_years(spark, d):
    return rounded(movies.busiest_years(with_keyword(spark, d)), *YEAR_MEANS)


@query("best_rated_years", with_sql(*KEYWORD_CTES, select=YEAR_SQL + " ORDER BY avg_rating DESC, release_year LIMIT 10"))
def best_rated_years(spark, d):
    return rounded(movies.best_rated_years(with_keyword(spark, d)), *YEAR_MEANS)


@query("topk_values", with_sql(*KEYWORD_CTES, TOP_EIGHT, select="SELECT * FROM top_eight"))
def topk_values(spark, d):
    present = with_keyword(spark, d).na.drop(subset=["main_keyword", "release_decade"])
    return top_values(present, "main_keyword", 8)


@query("rows_of_top_values", with_sql(*KEYWORD_CTES, TOP_EIGHT, select="""
SELECT movie_id, main_keyword, release_decade FROM with_keyword
WHERE main_keyword IN (SELECT main_keyword FROM top_eight) AND release_decade IS NOT NULL"""))
def rows_of_top_values(spark, d):
    return movies.top_keyword_movies(with_keyword(spark, d)).select("movie_id", "main_keyword", "release_decade")


@query("value_counts", with_sql(*KEYWORD_CTES, select="""
SELECT main_keyword, count(*) AS count FROM with_keyword WHERE main_keyword IS NOT NULL GROUP BY main_keyword"""))
def keyword_value_counts(spark, d):
    return value_counts(with_keyword(spark, d), "main_keyword")


@query("decade_keyword_pivot", with_sql(*KEYWORD_CTES, TOP_EIGHT, select="""
SELECT release_decade, """ + ", ".join(
    f"count(title) FILTER (WHERE main_keyword = '{k}') AS {k}"
    for k in KEYWORDS[:8]
) + " FROM with_keyword WHERE main_keyword IN (SELECT main_keyword FROM top_eight) AND release_decade IS NOT NULL GROUP BY release_decade"))
def decade_keyword_pivot(spark, d):
    return movies.decade_keyword_pivot(with_keyword(spark, d))


def business_sql(mean):
    return """
SELECT main_keyword, count(title) AS movie_count, """ + ", ".join(
        f"{mean.format(column)} AS avg_{name}"
        for name, column in (
            ("rating", "vote_average"), ("vote_count", "vote_count"), ("revenue", "revenue"), ("profit", "profit"), ("roi", "roi")
        )
    ) + " FROM with_keyword WHERE main_keyword IN (SELECT main_keyword FROM top_eight) AND release_decade IS NOT NULL GROUP BY main_keyword"


@query("keyword_business", with_sql(*KEYWORD_CTES, TOP_EIGHT, select=business_sql("round(avg({}), 6)")))
def keyword_business(spark, d):
    wide = movies.keyword_business(with_keyword(spark, d))
    return rounded(wide, *movies.BUSINESS_METRICS[1:])


@query("keyword_business_long", with_sql(*KEYWORD_CTES, TOP_EIGHT, select=f"""
SELECT main_keyword, metric, round(value, 6) AS value FROM (
  SELECT * REPLACE (CAST(movie_count AS DOUBLE) AS movie_count) FROM ({business_sql("avg({})")}))
UNPIVOT (value FOR metric IN (movie_count, avg_rating, avg_vote_count, avg_revenue, avg_profit, avg_roi))"""))
def keyword_business_long(spark, d):
    return rounded(movies.keyword_business_long(with_keyword(spark, d)), "value")


@query("movie_keywords", with_sql(LINES, MOVIE_KEYWORDS, select="SELECT * FROM movie_keywords"))
def movie_keywords(spark, d):
    return movies.movie_keywords(keywords_one(spark, d))


@query("movie_cast", with_sql(LINES, MOVIE_CAST, select="SELECT * FROM movie_cast"))
def movie_cast(spark, d):
    return movies.movie_cast(credits_one(spark, d))


@query("movie_crew", with_sql(LINES, MOVIE_CREW, select="SELECT * FROM movie_crew"))
def movie_crew(spark, d):
    return movies.movie_crew(credits_one(spark, d))


@query("directors", with_sql(LINES, MOVIE_CREW, select="SELECT * FROM movie_crew WHERE job = 'Director'"))
def directors(spark, d):
    return movies.directors(movies.movie_crew(credits_one(spark, d)))


@query("duplicate_summary", with_sql("raw_credits", "raw_keywords", select="""
SELECT 'credits' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows FROM (
  SELECT count(*) AS n FROM raw_credits WHERE TRY_CAST(id AS BIGINT) IS NOT NULL GROUP BY id HAVING count(*) > 1)
UNION ALL
SELECT 'keywords', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
  SELECT count(*) AS n FROM raw_keywords WHERE TRY_CAST(id AS BIGINT) IS NOT NULL GROUP BY id HAVING count(*) > 1)"""))
def duplicate_summary(spark, d):
    tables = {n: movies.with_movie_id(feed(spark, d, f"raw_{n}")) for n in ("credits", "keywords")}
    return quality.duplicate_summary(tables, ["movie_id"])


@query("credits_keywords", with_sql("raw_credits", "raw_keywords", select=f"""
SELECT CAST(c.id AS BIGINT) AS movie_id, c."cast", c.crew, k.keywords
FROM (SELECT * FROM raw_credits WHERE TRY_CAST(id AS BIGINT) IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY {ORDER_SQL}) = 1) c
JOIN (SELECT * FROM raw_keywords WHERE TRY_CAST(id AS BIGINT) IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY {ORDER_SQL}) = 1) k ON c.id = k.id"""))
def credits_keywords(spark, d):
    return movies.credits_keywords(credits_one(spark, d), keywords_one(spark, d))


@query("top_keywords", with_sql(LINES, MOVIE_KEYWORDS, select="""
SELECT keyword_name, count(DISTINCT movie_id) AS movie_count FROM movie_keywords GROUP BY keyword_name"""))
def top_keywords(spark, d):
    return movies.top_keywords(movies.movie_keywords(keywords_one(spark, d)))


@query("keyword_rating_summary", with_sql(*CLEAN_CTES, LINES, MOVIE_KEYWORDS, select="""
SELECT keyword_name, count(DISTINCT movie_id) AS movie_count, round(avg(vote_average), 6) AS avg_vote_average,
  coalesce(sum(vote_count), 0) AS total_vote_count
FROM movie_keywords JOIN clean USING (movie_id) WHERE vote_average IS NOT NULL
GROUP BY keyword_name HAVING count(DISTINCT movie_id) >= 20"""))
def keyword_rating_summary(spark, d):
    summary = movies.keyword_rating_summary(movies.movie_keywords(keywords_one(spark, d)), clean(spark, d))
    return rounded(summary, "avg_vote_average")


@query("actor_keyword_summary", with_sql(LINES, MOVIE_KEYWORDS, MOVIE_CAST, select="""
SELECT actor_name, keyword_name, count(DISTINCT movie_id) AS movie_count
FROM movie_cast JOIN movie_keywords USING (movie_id) GROUP BY actor_name, keyword_name HAVING count(DISTINCT movie_id) >= 3"""))
def actor_keyword_summary(spark, d):
    cast = movies.movie_cast(credits_one(spark, d))
    return movies.actor_keyword_summary(cast, movies.movie_keywords(keywords_one(spark, d)))


@query("director_keyword_summary", with_sql(LINES, MOVIE_KEYWORDS, MOVIE_CREW, select="""
SELECT crew_name AS director_name, keyword_name, count(DISTINCT movie_id) AS movie_count
FROM movie_crew JOIN movie_keywords USING (movie_id) WHERE job = 'Director'
GROUP BY crew_name, keyword_name HAVING count(DISTINCT movie_id) >= 2"""))
def director_keyword_summary(spark, d):
    crew = movies.movie_crew(credits_one(spark, d))
    return movies.director_keyword_summary(crew, movies.movie_keywords(keywords_one(spark, d)))


# Two suppliers that deliver the same kind of part to the same order: N:M on lines, repeated items folded.
@query("bridge_join", """
SELECT a.l_suppkey AS supplier, b.p_type AS part_type, count(DISTINCT a.l_orderkey) AS orders
FROM lineitem a JOIN (SELECT l_orderkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey) b
  ON a.l_orderkey = b.l_orderkey GROUP BY a.l_suppkey, b.p_type HAVING count(DISTINCT a.l_orderkey) >= 2""")
def bridge_join(spark, d):
    from gristmill.operators.joins import pair_counts

    lines = table(spark, d, "lineitem")
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("part_type"))
    left = lines.select("l_orderkey", F.col("l_suppkey").alias("supplier"))
    right = lines.select("l_orderkey", "l_partkey").join(parts, "l_partkey").select("l_orderkey", "part_type")
    return pair_counts(left, right, "l_orderkey", "supplier", "part_type", 2, "orders")
