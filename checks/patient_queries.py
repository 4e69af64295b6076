"""Patient plans over customers, and the window operators they rest on over orders and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.bindings import feed, table
from checks.registry import mean_sql, query, rounded, with_sql
from gristmill.operators import ordered, windows
from gristmill.operators.aggregates import above_group_average
from gristmill.operators.cleaning import keep_first
from gristmill.operators.joins import attach_group_stats, inner_join
from gristmill.plans import patients as plan

LABEL = "CASE WHEN diagnosis = 1 THEN 'Cancer' ELSE 'No Cancer' END"
BAND = "banded AS (SELECT id, age, bmi, diagnosis, CAST(age // 10 * 10 AS BIGINT) AS age_band FROM patients)"
BAND_TOP = """band_top AS (
  SELECT *, row_number() OVER (PARTITION BY age_band ORDER BY bmi DESC, id) AS bmi_row_num_in_age_band FROM banded
  QUALIFY bmi_row_num_in_age_band <= 10)"""


def patients(spark, d):
    return feed(spark, d, "patients")


@query("raw_preview", with_sql("patients", select="""
SELECT id, age, gender, bmi, smoking, genetic_risk, diagnosis FROM patients ORDER BY id LIMIT 20"""))
def raw_preview(spark, d):
    return plan.raw_view(patients(spark, d))


@query("labelled_patients", with_sql("patients", select=f"""
SELECT id, age, bmi, diagnosis, {LABEL} AS diagnosis_label FROM patients"""))
def labelled_patients(spark, d):
    return plan.labelled(patients(spark, d))


@query("sorted_head", with_sql("patients", select="""
SELECT id, age, bmi, diagnosis FROM patients ORDER BY bmi DESC NULLS FIRST, id LIMIT 20"""))
def sorted_head(spark, d):
    return plan.heaviest(patients(spark, d))


@query("offset_page", with_sql("patients", select="""
SELECT id, age, bmi, diagnosis FROM patients ORDER BY bmi DESC NULLS FIRST, id LIMIT 7 OFFSET 2"""))
def offset_page(spark, d):
    return plan.bmi_page(patients(spark, d))


@query("rank_global", with_sql("patients", select="""
SELECT id, age, bmi, diagnosis, rank() OVER (ORDER BY bmi DESC NULLS FIRST) AS bmi_rank_all FROM patients"""))
def rank_global(spark, d):
    return plan.bmi_ranked(patients(spark, d))


@query("rank_slice", with_sql("patients", select="""
SELECT id, age, bmi, diagnosis, rank() OVER (ORDER BY bmi DESC NULLS FIRST) AS bmi_rank_all FROM patients
QUALIFY bmi_rank_all BETWEEN 3 AND 10"""))
def rank_slice(spark, d):
    return plan.bmi_rank_slice(patients(spark, d))


@query("rank_in_group", with_sql("patients", select="""
SELECT id, diagnosis, age, bmi, genetic_risk, rank() OVER (PARTITION BY diagnosis ORDER BY bmi DESC NULLS FIRST)
  AS bmi_rank_in_group FROM patients"""))
def rank_in_group(spark, d):
    return plan.bmi_ranked_in_group(patients(spark, d))


@query("rank_limit_in_group", with_sql("patients", select="""
SELECT id, diagnosis, bmi, rank() OVER (PARTITION BY diagnosis ORDER BY bmi DESC NULLS FIRST) AS bmi_rank FROM patients
QUALIFY bmi_rank <= 3"""))
def rank_limit_in_group(spark, d):
    return plan.bmi_ranks_up_to(patients(spark, d))


@query("topn_in_group", with_sql("patients", select=f"""
SELECT id, {LABEL} AS diagnosis_label, age, bmi, genetic_risk,
  rank() OVER (PARTITION BY diagnosis ORDER BY bmi DESC NULLS FIRST) AS bmi_rank_in_group,
  row_number() OVER (PARTITION BY diagnosis ORDER BY bmi DESC NULLS FIRST, id) AS sample_row_num
FROM patients QUALIFY sample_row_num <= 3"""))
def topn_in_group(spark, d):
    return plan.top_of_group(patients(spark, d))


@query("group_average", with_sql("patients", select="""
SELECT diagnosis, round(avg(bmi), 2) AS avg_bmi FROM patients GROUP BY diagnosis"""))
def group_average(spark, d):
    return plan.group_average(patients(spark, d))


BESIDE = """
SELECT id, diagnosis, age, bmi, count(*) OVER (PARTITION BY diagnosis) AS group_patient_count,
  round(avg(bmi) OVER (PARTITION BY diagnosis), 2) AS group_avg_bmi,
  round(bmi - avg(bmi) OVER (PARTITION BY diagnosis), 2) AS bmi_diff_from_group_avg"""


@query("group_avg_window", with_sql("patients", select=BESIDE + " FROM patients"))
def group_avg_window(spark, d):
    return plan.beside_group(patients(spark, d))


@query("diff_from_avg", with_sql("patients", select=BESIDE + f""", {LABEL} AS diagnosis_label,
  row_number() OVER (PARTITION BY diagnosis ORDER BY bmi DESC NULLS FIRST, id) AS sample_row_num
FROM patients QUALIFY sample_row_num <= 3"""))
def diff_from_avg(spark, d):
    return plan.top_beside_group(patients(spark, d))


@query("group_size_window", "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, "
       "count(*) OVER (PARTITION BY l_returnflag) AS flag_rows, count(*) OVER (PARTITION BY l_orderkey) AS order_rows FROM lineitem")
def group_size_window(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    by_flag = attach_group_stats(lines, ["l_returnflag"], {"flag_rows": F.count("*")})
    return attach_group_stats(by_flag, ["l_orderkey"], {"order_rows": F.count("*")})


@query("age_bands", with_sql("patients", BAND, select="SELECT * FROM banded"))
def age_bands(spark, d):
    return plan.with_age_band(patients(spark, d))


@query("rank_in_age_band", with_sql("patients", BAND, select="""
SELECT *, rank() OVER (PARTITION BY age_band ORDER BY bmi DESC NULLS FIRST) AS bmi_rank_in_age_band FROM banded"""))
def rank_in_age_band(spark, d):
    return plan.ranked_in_age_band(patients(spark, d))


@query("band_topn", with_sql("patients", BAND, BAND_TOP, select="SELECT * FROM band_top"))
def band_topn(spark, d):
    return plan.top_of_age_band(patients(spark, d))


@query("band_topn_rate", with_sql("patients", BAND, BAND_TOP, select="""
SELECT age_band, count(*) AS patient_count, CAST(sum(diagnosis) AS BIGINT) AS cancer_patient_count,
  """ + mean_sql("diagnosis", 3) + " AS cancer_ratio FROM band_top GROUP BY age_band"))
def band_topn_rate(spark, d):
    return plan.age_band_cancer_ratio(patients(spark, d))


@query("above_group_avg", """
SELECT c_custkey, c_nationkey, n_name, c_acctbal, round(avg_balance, 6) AS avg_balance FROM (
  SELECT c.*, n.n_name, avg(c_acctbal) OVER (PARTITION BY c_nationkey) AS avg_balance
  FROM customer c JOIN nation n ON c_nationkey = n_nationkey) WHERE c_acctbal > avg_balance""")
def above_group_avg(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    based = inner_join(customers, nations, ["c_nationkey"], unique_right=True)
    return rounded(above_group_average(based, ["c_nationkey"], "c_acctbal", "avg_balance"), "avg_balance").select(
        "c_custkey", "c_nationkey", "n_name", "c_acctbal", "avg_balance"
    )


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("positions_in_group", """
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate)
  AS price_number FROM lineitem""")
def positions_in_group(spark, d):
    lines = table(spark, d, "lineitem").select("l_returnflag", *LINE_KEY, "l_shipdate", "l_extendedprice")
    order = [F.desc_nulls_first("l_extendedprice"), *[F.asc(c) for c in [*LINE_KEY, "l_shipdate"]]]
    return ordered.positions(lines, ["l_returnflag"], order, "price_number").drop("l_shipdate")


@query("dense_rank_ntile", """
SELECT o_orderkey, o_orderpriority, CAST(floor(o_totalprice / 1000) AS BIGINT) AS price_band,
  dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY floor(o_totalprice / 1000) DESC) AS band_rank,
  CAST(ntile(4) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS price_quarter FROM orders""")
def dense_rank_ntile(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", F.floor(F.col("o_totalprice") / 1000).alias("price_band")
    )
    ranked = ordered.ranks(orders, ["o_orderpriority"], "price_band", dense="band_rank")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return ordered.tiles(ranked, [], order, 4, "price_quarter").drop("o_totalprice")


@query("first_per_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) = 1""")
def first_per_key(spark, d):
    lines = table(spark, d, "lineitem").select(*LINE_KEY, "l_extendedprice", "l_shipdate")
    order = [F.asc(c) for c in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")]
    return windows.first_per_key(lines, ["l_orderkey"], order).drop("l_shipdate")


@query("keep_first_lines", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate) = 1""")
def keep_first_lines(spark, d):
    lines = table(spark, d, "lineitem").select(*LINE_KEY, "l_quantity", "l_shipdate")
    order = [F.asc(c) for c in ("l_partkey", "l_suppkey", "l_shipdate")]
    return keep_first(lines, ["l_orderkey", "l_linenumber"], order).drop("l_shipdate")


# Weekly sales of each return flag: a series with one row per week, so frames over it stay short.
SERIES = """series AS (
  SELECT l_returnflag AS flag, CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
    CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY ALL)"""
TOTAL = "totals AS (SELECT week, CAST(sum(quantity) AS BIGINT) AS quantity FROM series GROUP BY week)"
ON = "PARTITION BY flag ORDER BY week"


def series(spark, d):
    return (
        table(spark, d, "lineitem")
        .groupBy(F.col("l_returnflag").alias("flag"), F.date_trunc("week", "l_shipdate").cast("date").alias("week"))
        .agg(F.sum("l_quantity").cast("bigint").alias("quantity"))
    )


@query("lag_series", with_sql(SERIES, TOTAL, select="""
SELECT week, quantity, lag(quantity) OVER (ORDER BY week) AS prev_week_quantity FROM totals"""))
def lag_series(spark, d):
    totals = series(spark, d).groupBy("week").agg(F.sum("quantity").alias("quantity"))
    return windows.neighbours(totals, [], [F.asc("week")], "quantity", previous="prev_week_quantity")


@query("lag_change", with_sql(SERIES, select=f"""
SELECT *, lag(quantity) OVER ({ON}) AS previous, quantity - lag(quantity) OVER ({ON}) AS change FROM series"""))
def lag_change(spark, d):
    return windows.neighbours(series(spark, d), ["flag"], [F.asc("week")], "quantity", previous="previous", change="change")


@query("lead_first_last", with_sql(SERIES, select=f"""
SELECT *, lead(quantity) OVER ({ON}) AS following, first_value(quantity) OVER ({ON}) AS first_quantity,
  last_value(quantity) OVER ({ON} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_quantity FROM series"""))
def lead_first_last(spark, d):
    nexts = windows.neighbours(series(spark, d), ["flag"], [F.asc("week")], "quantity", following="following")
    return windows.ends_of_series(nexts, ["flag"], [F.asc("week")], "quantity", "first_quantity", "last_quantity")


@query("running_sum", with_sql(SERIES, select=f"""
SELECT *, CAST(sum(quantity) OVER ({ON} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS so_far FROM series"""))
def running_sum(spark, d):
    return windows.running(series(spark, d), ["flag"], [F.asc("week")], "quantity", "so_far")


@query("running_sum_range", with_sql(SERIES, select="""
SELECT flag, week, quantity, CAST(sum(quantity) OVER (ORDER BY week RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
  AS so_far FROM series"""))
def running_sum_range(spark, d):
    return windows.running(series(spark, d), [], [F.asc("week")], "quantity", "so_far", by_range=["week"])


@query("moving_avg", with_sql(SERIES, select=f"""
SELECT *, round(avg(quantity) OVER ({ON} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6) AS mean_4,
  min(quantity) OVER ({ON} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS low_4,
  max(quantity) OVER ({ON} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS high_4 FROM series"""))
def moving_avg(spark, d):
    frames = windows.moving(
        series(spark, d), ["flag"], [F.asc("week")], "quantity", 4, {"mean_4": "avg", "low_4": "min", "high_4": "max"}
    )
    return rounded(frames, "mean_4")


@query("running_total_lines", """
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity,
  CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_returnflag
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
  AS quantity_before FROM lineitem""")
def running_total_lines(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_returnflag", *LINE_KEY, "l_shipdate", F.col("l_quantity").cast("bigint").alias("quantity")
    )
    order = [F.asc(c) for c in ("l_shipdate", *LINE_KEY)]
    return ordered.totals_before(lines, ["l_returnflag"], order, {"quantity_before": "quantity"}).drop("l_shipdate")


@query("inner_join_n_to_one", """
SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def inner_join_n_to_one(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return inner_join(orders, customers, ["o_custkey"], unique_right=True)


@query("three_way_join", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderpriority, p_type, s_nationkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""")
def three_way_join(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = inner_join(lines, orders, ["l_orderkey"])
    return inner_join(inner_join(joined, parts, ["l_partkey"]), suppliers, ["l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderpriority", "p_type", "s_nationkey"
    )
