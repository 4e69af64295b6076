"""Files and stored tables: given tables are written to the shared folder, read back and typed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import movie_queries
from checks.bindings import feed, table
from checks.chart_queries import LEAKAGE_CTES, SAFE_CTES, leakage, safe
from checks.registry import EXPECTED, query, with_sql
from gristmill.operators import joins, quality
from gristmill.scratch import shared_folder
from gristmill.sources import files, tables

NOTES = """SELECT o_orderkey AS id, 'Prix "' || o_orderpriority || '" – ' || o_orderstatus || ', été' AS note,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'ligne ' || length(o_orderpriority) || chr(10) || 'über' END AS remark,
  CAST(o_orderdate AS DATE) AS day FROM orders"""


def place(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def notes(spark, d):
    return table(spark, d, "orders").selectExpr(
        "o_orderkey AS id", "'Prix \"' || o_orderpriority || '\" – ' || o_orderstatus || ', été' AS note",
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'ligne ' || length(o_orderpriority) || '\n' || 'über' END AS remark",
        "CAST(o_orderdate AS DATE) AS day",
    )


def round_trip(spark, d, charset):
    # this session may not have been built by session.py
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    path = files.export_csv(notes(spark, d), place(spark, f"notes-{charset}"), charset)
    read = files.read_csv(spark, path, charset=charset, date_columns=["day"], parts=8)
    return read.withColumn("id", F.col("id").cast("bigint"))


@query("csv_utf8", NOTES)
def csv_utf8(spark, d):
    return round_trip(spark, d, "utf-8")


@query("csv_cp1252", NOTES)
def csv_cp1252(spark, d):
    return round_trip(spark, d, "cp1252")


@query("csv_mac_roman", NOTES)
def csv_mac_roman(spark, d):
    return round_trip(spark, d, "mac-roman")


def loaded(spark, df, spec):
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    path = files.export_csv(df, place(spark, spec.name), spec.charset)
    return tables.load_csv_table(spark, path, spec)


@query("typed_load_health", """
SELECT c_custkey % 90 AS age, CAST(length(c_mktsegment) % 2 AS INTEGER) AS gender, c_acctbal / 100 AS bmi,
  CASE WHEN c_acctbal < 0 THEN 1 END AS smoking, CAST(length(c_name) % 3 AS INTEGER) AS genetic_risk,
  CAST(c_nationkey AS DOUBLE) AS physical_activity, NULL AS alcohol_intake, 0 AS cancer_history, c_nationkey % 2 AS diagnosis FROM customer""")
def typed_load_health(spark, d):
    raw = table(spark, d, "customer").selectExpr(
        "CAST(c_custkey % 90 AS STRING) || '.9' AS Age", "length(c_mktsegment) % 2 AS Gender", "c_acctbal / 100 AS BMI",
        "CASE WHEN c_acctbal < 0 THEN ' 1 ' ELSE 'n/a' END AS Smoking", "length(c_name) % 3 AS GeneticRisk",
        "c_nationkey AS PhysicalActivity", "'much' AS AlcoholIntake", "'0' AS CancerHistory", "c_nationkey % 2 AS Diagnosis",
    )
    return loaded(spark, raw, tables.HEALTH)


@query("typed_load_titles", """
SELECT 's' || o_orderkey AS show_id, 'Movie' AS type, 'Título ' || o_orderkey AS title, NULL AS director, o_clerk_name AS "cast",
  NULL AS country, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_added, CAST(year(o_orderdate) AS INTEGER) AS release_year, NULL AS rating,
  '90 min' AS duration, o_orderpriority AS listed_in, 'a "b", c' AS description, 90 AS duration_value
FROM (SELECT *, 'Clerk ' || o_custkey AS o_clerk_name FROM orders)""")
def typed_load_titles(spark, d):
    raw = table(spark, d, "orders").selectExpr(
        "'s' || o_orderkey AS show_id", "'Movie' AS type", "'Título ' || o_orderkey AS title", "CAST(NULL AS STRING) AS director",
        "'Clerk ' || o_custkey AS cast", "'N/A' AS country", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_added",
        "year(o_orderdate) AS release_year", "'' AS rating", "'90 min' AS duration", "o_orderpriority AS listed_in",
        "'a \"b\", c' AS description", "'90.0' AS duration_value",
    )
    # every key twice, the second with another title: the first of a key stays
    again = raw.withColumn("title", F.lit("later"))
    in_order = [F.col("show_id"), F.col("title") == "later"]
    return loaded(spark, raw.unionByName(again).repartitionByRange(*in_order).sortWithinPartitions(*in_order), tables.TITLES)


@query("typed_load_mart", """
SELECT CAST(l_shipdate AS DATE) AS week_date, CAST(month(l_shipdate) AS INTEGER) AS month_num, 'any' AS season,
  'line ' || l_orderkey AS title_clean, 'Line ' || l_orderkey AS show_title, l_linenumber AS weekly_rank_num,
  CAST(l_quantity AS BIGINT) AS weekly_hours_viewed_num, l_linenumber AS cumulative_weeks_in_top_10_num,
  l_returnflag AS type_clean, l_linestatus AS genre FROM lineitem""")
def typed_load_mart(spark, d):
    raw = table(spark, d, "lineitem").selectExpr(
        "CAST(l_shipdate AS DATE) AS week_date", "month(l_shipdate) AS month_num", "'any' AS season", "'line ' || l_orderkey AS title_clean",
        "'Line ' || l_orderkey AS show_title", "l_linenumber AS weekly_rank_num", "l_quantity AS weekly_hours_viewed_num",
        "l_linenumber AS cumulative_weeks_in_top_10_num", "l_returnflag AS type_clean", "l_linestatus AS genre",
    )
    return loaded(spark, raw, tables.MART)


@query("model_input_from_csv", with_sql(*SAFE_CTES, select="SELECT * REPLACE (nullif(primary_genre, 'nan') AS primary_genre) FROM safe"))
def model_input_from_csv(spark, d):
    path = files.export_csv(safe(spark, d), place(spark, "model-input"))
    return tables.read_table_or_file(spark, "model_input_safe", path, "first_week_date")[0]


@query("leakage_input_from_csv", with_sql(*LEAKAGE_CTES, select="SELECT * REPLACE (nullif(primary_genre, 'nan') AS primary_genre) FROM leakage"))
def leakage_input_from_csv(spark, d):
    path = files.export_csv(leakage(spark, d), place(spark, "leakage-input"))
    return tables.read_table_or_file(spark, "model_input_leakage", path, "first_week_date")[0]


@query("stored_table", """
SELECT c_custkey, c_nationkey FROM customer UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_acctbal < 0""")
def stored_table(spark, d):
    """Replaced twice, appended to once, read by an allowed name."""
    rows, name = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), f"stored_{uuid.uuid4().hex}"
    tables.replace_table(rows.limit(1), name)
    tables.replace_table(rows.drop("c_acctbal"), name)
    tables.append_table(rows.where("c_acctbal < 0").select("c_custkey", F.lit(-1).cast(rows.schema["c_nationkey"].dataType).alias("c_nationkey")), name)
    return tables.read_table(spark, name, [name])


@query("serial_ids", """
SELECT i // 1000 AS block, count(*) AS ids, count(*) AS different_ids, min(i) + 1 AS least, max(i) + 1 AS most
FROM range((SELECT count(*) FROM lineitem) + (SELECT count(*) FROM orders)) AS r(i) GROUP BY 1""")
def serial_ids(spark, d):
    """Order keys of lines, which repeat, numbered; those of orders numbered on from there."""
    first = tables.serial_ids(table(spark, d, "lineitem").select("l_orderkey"))
    more = tables.serial_ids(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")), first)
    blocks = first.unionByName(more).groupBy(F.floor((F.col("id") - 1) / 1000).alias("block"))
    return blocks.agg(F.count("*").alias("ids"), F.count_distinct("id").alias("different_ids"), F.min("id").alias("least"), F.max("id").alias("most"))


@query("reused_result", "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus")
def reused_result(spark, d):
    """Built at first, then stored and reused; the second build is never called."""

    def build():
        return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("orders"))

    path = place(spark, "reused")
    files.write_parquet(tables.reuse_or_build(spark, path, build), path)
    return tables.replace_view(tables.reuse_or_build(spark, path, lambda: build().limit(0)), f"reused_{uuid.uuid4().hex}")


@query("raw_lag_by_flag", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
  lag(l_extendedprice) OVER w AS previous, lead(l_extendedprice) OVER w AS following,
  sum(l_linenumber) OVER (w ROWS UNBOUNDED PRECEDING) AS so_far,
  min(l_extendedprice) OVER (w ROWS 4 PRECEDING) AS low, max(l_extendedprice) OVER (w ROWS 4 PRECEDING) AS high,
  first_value(l_extendedprice) OVER w AS first_price,
  last_value(l_extendedprice) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_price
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)""")
def raw_lag_by_flag(spark, d):
    """Neighbours, running sums, ends and frames over raw lines, three hot groups."""
    from gristmill.operators import windows

    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice")
    groups, order = ["l_returnflag"], [F.asc(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    price = "l_extendedprice"
    frames = {"previous": ("max", price, -1, -1), "following": ("max", price, 1, 1), "low": ("min", price, -4, 0), "high": ("max", price, -4, 0)}
    rows = windows.along(rows, groups, order, frames, {"so_far": "l_linenumber"}, {price: ("first_price", "last_price")})
    return rows.drop("l_partkey", "l_suppkey")


@query("weekly_text_dates", with_sql("weekly_text", select="SELECT CAST(week AS DATE) AS week, count(*) AS lines FROM weekly_text GROUP BY 1"))
def weekly_text_dates(spark, d):
    """A declared date column read from a file."""
    path = files.export_csv(feed(spark, d, "weekly_text"), place(spark, "weekly-text"))
    return files.read_csv(spark, path, columns=["week"], date_columns=["week"], parts=8).groupBy("week").agg(F.count("*").alias("lines"))


@query("pivot_csv", EXPECTED["decade_keyword_pivot"])
def pivot_csv(spark, d):
    """A pivot with its index column as a file, read back."""
    pivot = movie_queries.decade_keyword_pivot(spark, d)
    path = files.export_csv(pivot, place(spark, "pivot"))
    read = files.read_csv(spark, path, header=pivot.columns)
    return read.select(*[F.col(f.name).cast(f.dataType) for f in pivot.schema.fields])


HINDSIGHT = ("best_rank", "max_cumulative_weeks", "weeks_in_top10")


@query("hindsight_columns", with_sql(*LEAKAGE_CTES, select=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS present, count(DISTINCT {c}) AS different FROM leakage" for c in HINDSIGHT)))
def hindsight_columns(spark, d):
    """What the leakage table has beyond the safe one: the extra columns, found by comparing schemas, and how they are filled."""
    wide = leakage(spark, d)
    extra = quality.extra_columns(wide, safe(spark, d))
    long = wide.select(*[F.col(c).cast("bigint").alias(c) for c in extra]).unpivot([], extra, "column_name", "value")
    return long.groupBy("column_name").agg(F.count("value").alias("present"), F.count_distinct("value").alias("different"))


@query("aligned_scores", with_sql("scored", select="SELECT title_clean, show_title, type_clean, actual, score FROM scored"))
def aligned_scores(spark, d):
    """Scores put beside the rows they belong to: aligned by key, as rows of two tables have no common order."""
    rows = feed(spark, d, "scored")
    scores = rows.select("title_clean", "score").repartition(F.hash("score"))
    return joins.inner_join(rows.drop("score"), scores, ["title_clean"], unique_left=True, unique_right=True).select(
        "title_clean", "show_title", "type_clean", "actual", "score")
