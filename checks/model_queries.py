"""Loading, evaluation and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.bindings import feed, table
from checks.chart_queries import SAFE_CTES, leakage, safe
from checks.registry import query, rounded, with_sql
from gristmill.operators import ordered, quality
from gristmill.operators.reshape import explode_list
from gristmill.functions.text import join_key, list_items
from gristmill.plans import evaluation, modeling
from gristmill.sources import tables

CELLS = """
  count(*) FILTER (WHERE actual = 0 AND predicted = 0) AS tn, count(*) FILTER (WHERE actual = 0 AND predicted = 1) AS fp,
  count(*) FILTER (WHERE actual = 1 AND predicted = 0) AS fn, count(*) FILTER (WHERE actual = 1 AND predicted = 1) AS tp"""
PREDICTED = "predicted_rows AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted FROM scored)"
COUNTED = f"counted AS (SELECT {CELLS} FROM predicted_rows)"
RATES = """CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1"""
# Area by average ranks of the positives.
AREA = """(SELECT round((sum(r) FILTER (WHERE actual = 1) - count(*) FILTER (WHERE actual = 1) * (count(*) FILTER (WHERE actual = 1) + 1) / 2)
    / (count(*) FILTER (WHERE actual = 1) * count(*) FILTER (WHERE actual = 0)), 9)
  FROM (SELECT actual, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0E0 AS r FROM scored))"""
OUTPUT = """output AS (
  SELECT title_clean, show_title, type_clean, primary_genre, first_week_date, score AS long_run_probability,
    CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted_long_run_flag, actual AS actual_long_run_flag,
    'random_forest_randomized_v1' AS model_version, 0.5E0 AS threshold FROM scored)"""


def scored(spark, d):
    return feed(spark, d, "scored")


def predicted(spark, d):
    return scored(spark, d).withColumn("predicted", evaluation.predicted_flag("score", 0.5))


def output(spark, d):
    return evaluation.scored_output(scored(spark, d), "score", "actual", modeling.MODEL_VERSION)


@query("confusion", with_sql("scored", PREDICTED, COUNTED, select="SELECT * FROM counted"))
def confusion(spark, d):
    return evaluation.confusion(predicted(spark, d), "actual", "predicted")


@query("metric_row", with_sql("scored", PREDICTED, COUNTED, select=f"""
SELECT 'baseline' AS model, round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round(precision, 9) AS precision,
  round(recall, 9) AS recall, round(f1, 9) AS f1, {AREA} AS roc_auc FROM (SELECT *, {RATES} FROM counted)"""))
def metric_row(spark, d):
    row = evaluation.metric_row(predicted(spark, d), "baseline", "actual", "predicted", "score")
    return rounded(row, "accuracy", "precision", "recall", "f1", "roc_auc", digits=9)


@query("auc", with_sql("scored", select=f"SELECT {AREA} AS auc"))
def auc(spark, d):
    return rounded(ordered.area_under_curve(scored(spark, d), "score", "actual"), "auc", digits=9)


@query("threshold_sweep", with_sql("scored", select="\nUNION ALL ".join(f"""
SELECT {t}E0 AS threshold, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
  fp AS false_positive, fn AS false_negative, tp + fp AS predicted_count FROM (
  SELECT *, {RATES} FROM (SELECT {CELLS} FROM (SELECT *, CASE WHEN score >= {t}E0 THEN 1 ELSE 0 END AS predicted FROM scored)))"""
    for t in evaluation.THRESHOLDS)))
def threshold_sweep(spark, d):
    sweep = evaluation.threshold_sweep(scored(spark, d), "actual", "score")
    return rounded(sweep, "precision", "recall", "f1", digits=9)


@query("scored_output", with_sql("scored", OUTPUT, select="SELECT * FROM output"))
def scored_output(spark, d):
    return output(spark, d)


@query("dashboard_summary", with_sql("scored", PREDICTED, COUNTED, select=f"""
SELECT tn + fp + fn + tp AS content_count, (SELECT round(avg(score), 6) FROM scored) AS avg_probability,
  tp + fp AS predicted_count, tp + fn AS actual_long_run_count, round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(f1, 9) AS f1, fp AS false_positive, fn AS false_negative FROM (SELECT *, {RATES} FROM counted)"""))
def dashboard_summary(spark, d):
    summary = evaluation.dashboard_summary(output(spark, d))
    return rounded(rounded(summary, "avg_probability"), "precision", "recall", "f1", digits=9)


@query("dashboard_top", with_sql("scored", OUTPUT, select="""
SELECT * EXCLUDE (model_version, threshold) FROM output ORDER BY long_run_probability DESC, title_clean LIMIT 12"""))
def dashboard_top(spark, d):
    return evaluation.top_candidates(output(spark, d))


@query("dashboard_by_type", with_sql("scored", OUTPUT, select="""
SELECT type_clean, count(*) AS content_count, round(avg(long_run_probability), 6) AS avg_probability,
  CAST(sum(predicted_long_run_flag) AS BIGINT) AS predicted_count FROM output GROUP BY type_clean"""))
def dashboard_by_type(spark, d):
    return rounded(evaluation.by_type(output(spark, d)), "avg_probability")


@query("dashboard_by_genre", with_sql("scored", OUTPUT, select="""
SELECT primary_genre, count(*) AS content_count, round(avg(long_run_probability), 6) AS avg_probability FROM output
GROUP BY primary_genre HAVING count(*) >= 2 ORDER BY avg(long_run_probability) DESC, primary_genre LIMIT 8"""))
def dashboard_by_genre(spark, d):
    return rounded(evaluation.by_genre(output(spark, d)), "avg_probability")


WHOLE = "TRY_CAST(trunc(TRY_CAST(trim({0}) AS DOUBLE)) AS {1})"


@query("typed_load", with_sql("weekly_text", select=f"""
SELECT CAST(week AS DATE) AS week, category, {WHOLE.format('weekly_rank', 'INTEGER')} AS weekly_rank, show_title, season_title,
  {WHOLE.format('weekly_hours_viewed', 'BIGINT')} AS weekly_hours_viewed, TRY_CAST(runtime AS DOUBLE) AS runtime,
  {WHOLE.format('weekly_views', 'BIGINT')} AS weekly_views, {WHOLE.format('cumulative_weeks_in_top_10', 'INTEGER')}
    AS cumulative_weeks_in_top_10,
  coalesce(lower(trim(is_staggered_launch)) IN ('true', '1', 't', 'yes', 'y'), false) AS is_staggered_launch,
  episode_launch_details FROM weekly_text"""))
def typed_load(spark, d):
    return tables.coerce(feed(spark, d, "weekly_text"), tables.WEEKLY)


@query("overlong_counts", with_sql("titles", select="""
SELECT count(*) FILTER (WHERE length(show_id) > 10) AS show_id, count(*) FILTER (WHERE length(type) > 50) AS type,
  count(*) FILTER (WHERE length(title) > 20) AS title FROM titles"""))
def overlong_counts(spark, d):
    spec = tables.TableSpec("titles", (
        tables.Field("show_id", limit=10), tables.Field("type", limit=50), tables.Field("title", limit=20),
    ))
    return tables.overlong_counts(feed(spark, d, "titles"), spec)


# Finished orders are stored already; order lines bring every order again, several times.
@query("insert_if_absent", """
SELECT l_orderkey AS order_id, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) = 1""")
def insert_if_absent(spark, d):
    stored = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("order_id"))
    batch = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    order = [F.asc(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")]
    return tables.insert_if_absent(stored, batch, "order_id", order).select("order_id", "l_partkey", "l_suppkey")


@query("surrogate_ids", "SELECT count(*) AS all_rows, count(*) AS ids, count(*) AS stamped FROM orders")
def surrogate_ids(spark, d):
    stamped = tables.stamp(table(spark, d, "orders"), ["o_orderkey"])
    return stamped.agg(
        F.count("*").alias("all_rows"), F.count_distinct("id").alias("ids"), F.count("created_at").alias("stamped")
    )


LOADED = ("customer", "orders", "lineitem", "events")


@query("load_counts", "WITH counts AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in LOADED)
    + ") SELECT * FROM counts UNION ALL SELECT 'total', CAST(sum(row_count) AS BIGINT) FROM counts")
def load_counts(spark, d):
    return quality.load_counts({t: table(spark, d, t) for t in LOADED})


@query("split_genres", with_sql("titles", select="""
SELECT lower(trim(title)) AS title_clean, trim(g) AS genre FROM titles, unnest(string_split(listed_in, ',')) AS u(g) WHERE trim(g) <> ''"""))
def split_genres(spark, d):
    titles = feed(spark, d, "titles").withColumn("title_clean", join_key(F.col("title")))
    return explode_list(titles, list_items(F.col("listed_in")), "genre").select("title_clean", "genre")


@query("medians_by_flag", """
SELECT l_returnflag, median(l_extendedprice) AS median_l_extendedprice, median(l_quantity) AS median_l_quantity,
  median(l_partkey) AS median_l_partkey FROM lineitem GROUP BY l_returnflag""")
def medians_by_flag(spark, d):
    return ordered.medians(table(spark, d, "lineitem"), ["l_returnflag"], ["l_extendedprice", "l_quantity", "l_partkey"])


@query("split_audit", with_sql(*SAFE_CTES, """shares AS (
  SELECT long_run_flag, count(*) AS n, CAST(round(0.25 * count(*)) AS BIGINT) AS t FROM safe GROUP BY long_run_flag)""", select="""
SELECT 'train_safe' AS dataset, 'model fit' AS role, CAST(sum(n - t) AS BIGINT) AS rows,
  CAST(sum(long_run_flag * (n - t)) AS BIGINT) AS long_run_count,
  round(sum(long_run_flag * (n - t)) / sum(n - t), 6) AS long_run_rate FROM shares
UNION ALL SELECT 'test_safe', 'final evaluation', CAST(sum(t) AS BIGINT), CAST(sum(long_run_flag * t) AS BIGINT),
  round(sum(long_run_flag * t) / sum(t), 6) FROM shares"""))
def split_audit(spark, d):
    return rounded(modeling.split_audit(modeling.split(safe(spark, d))), "long_run_rate")


@query("class_weights", with_sql(*SAFE_CTES, select="""
SELECT long_run_flag, count(*) AS class_rows, round((SELECT count(*) FROM safe) / (2.0E0 * count(*)), 9) AS class_weight
FROM safe GROUP BY long_run_flag"""))
def class_weights(spark, d):
    return rounded(modeling.class_weights(safe(spark, d)), "class_weight", digits=9)
