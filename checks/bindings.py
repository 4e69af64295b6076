"""Star-schema tables seen as the feeds the plans expect.

Each feed is a list of select expressions over one whole table.  Spark and the
comparison SQL evaluate the same text.  Dirt (bad numbers, missing values,
damaged titles, broken lists) depends on values the rows already hold;
repeated keys are the order lines of one order.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.session import SETTINGS, fit_shuffles

# What came first among the rows of one key: the order line with the smallest of these.
LINE_ORDER = ["line_no", "part_no", "supp_no", "ship_day"]
_ORDER = [
    "l_linenumber AS line_no",
    "l_partkey AS part_no",
    "l_suppkey AS supp_no",
    "CAST(l_shipdate AS DATE) AS ship_day",
]
_ID = (
    "CASE WHEN l_returnflag = 'R' AND l_tax = 0.08 THEN '/' || CAST(l_orderkey AS STRING) || '.jpg' "
    "ELSE CAST(l_orderkey AS STRING) END AS id"
)
# Keyword of a line by quantity, bands of falling width, so that eight clearly lead.
KEYWORD_NO = (
    "CASE WHEN l_quantity < 10 THEN 1 WHEN l_quantity < 18 THEN 2 WHEN l_quantity < 25 THEN 3 "
    "WHEN l_quantity < 31 THEN 4 WHEN l_quantity < 37 THEN 5 WHEN l_quantity < 42 THEN 6 "
    "WHEN l_quantity < 46 THEN 7 WHEN l_quantity < 49 THEN 8 WHEN l_quantity < 50 THEN 9 ELSE 10 END"
)
KEYWORDS = ["harbour", "violin", "lantern", "orchard", "thunder", "compass", "meadow", "copper", "glacier", "saddle"]
KEYWORD_NAME = f"CASE {KEYWORD_NO} " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KEYWORDS, 1)) + " END"
# How the name is spelled inside the literal: None for line 7, double quotes on returned lines.
KEYWORD_LITERAL = (
    f"CASE WHEN l_linenumber = 7 THEN 'None' WHEN l_returnflag = 'R' THEN '\"' || {KEYWORD_NAME} || '\"' "
    f"ELSE '''' || {KEYWORD_NAME} || '''' END"
)

FEEDS: dict[str, tuple[str, list[str]]] = {
    "raw_movies": ("lineitem", [
        _ID,
        "CASE WHEN l_linestatus = 'O' AND l_discount = 0.1 THEN NULL "
        "ELSE 'Order ' || CAST(l_orderkey AS STRING) || ' line ' || CAST(l_linenumber AS STRING) END AS title",
        "CASE WHEN l_returnflag = 'N' AND l_tax = 0.07 THEN '1' "
        "ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS release_date",
        "CASE l_returnflag WHEN 'R' THEN NULL WHEN 'A' THEN 'en' ELSE 'fr' END AS original_language",
        "CASE WHEN l_returnflag = 'A' AND l_tax = 0.06 THEN CAST(l_quantity AS STRING) || 'd' "
        "ELSE CAST(l_quantity - 2 AS STRING) END AS runtime",
        "CASE WHEN l_tax = 0 THEN NULL WHEN l_discount = 0.09 THEN '-' || CAST(l_extendedprice AS STRING) "
        "WHEN l_discount = 0 THEN '0' ELSE CAST(l_extendedprice AS STRING) END AS budget",
        "CAST(CAST(l_quantity AS BIGINT) * 1500 AS STRING) AS revenue",
        "CASE WHEN l_tax = 0.05 THEN 'Beware' ELSE CAST(l_discount AS STRING) END AS popularity",
        "CAST(l_quantity / 5 + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS STRING) AS vote_average",
        "CAST(CAST(floor(l_extendedprice / 100) AS BIGINT) AS STRING) AS vote_count",
        *_ORDER,
    ]),
    "raw_keywords": ("lineitem", [
        _ID,
        "CASE WHEN l_tax = 0.08 THEN 'broken' WHEN l_tax = 0.07 THEN NULL WHEN l_discount = 0.1 THEN '[]' "
        f"WHEN l_discount = 0.09 THEN '{{''id'': 1}}' ELSE '[{{''id'': ' || CAST({KEYWORD_NO} AS STRING) || "
        f"', ''name'': ' || {KEYWORD_LITERAL} || '}}, {{''id'': ' || CAST(100 + l_suppkey AS STRING) || "
        "', ''name'': \"supplier ' || CAST(l_suppkey AS STRING) || '''s\"}]' END AS keywords",
        *_ORDER,
    ]),
    "raw_credits": ("lineitem", [
        _ID,
        "CASE WHEN l_tax = 0.06 THEN 'broken' ELSE '[{''id'': ' || CAST(l_suppkey AS STRING) || ', ''name'': ''Actor ' || "
        "CAST(l_suppkey AS STRING) || ''', ''character'': None, ''order'': 0}, 5, {''id'': ' || "
        "CAST(l_partkey AS STRING) || ', ''name'': \"Star ' || CAST(l_partkey AS STRING) || '''s\", "
        "''character'': ''Line ' || CAST(l_linenumber AS STRING) || ''', ''order'': 1}]' END AS cast",
        "CASE WHEN l_tax = 0.05 THEN '[]' ELSE '[{''id'': ' || CAST(l_suppkey AS STRING) || ', ''name'': ''Maker ' || "
        "CAST(l_suppkey AS STRING) || ''', ''department'': ''Directing'', ''job'': ''Director''}, {''id'': ' || "
        "CAST(l_partkey AS STRING) || ', ''name'': ''Writer ' || CAST(l_partkey AS STRING) || "
        "''', ''department'': None, ''job'': ''Writer''}, {''id'': 1, ''name'': ''No job''}]' END AS crew",
        *_ORDER,
    ]),
    "weekly": ("lineitem", [
        "CAST(date_trunc('week', l_shipdate) AS DATE) AS week",
        "CASE WHEN l_tax = 0.08 AND l_discount = 0.1 THEN 'Order � #' || CAST(l_orderkey AS STRING) "
        "WHEN l_tax = 0.07 AND l_discount = 0.1 THEN NULL "
        "WHEN l_returnflag = 'R' THEN ' ORDER #' || CAST(l_orderkey AS STRING) || ' ' "
        "ELSE 'Order #' || CAST(l_orderkey AS STRING) END AS show_title",
        "CASE WHEN l_discount = 0 THEN NULL ELSE CAST(round(l_discount * 100) AS INT) END AS weekly_rank",
        "CASE WHEN l_tax = 0.06 AND l_discount = 0.05 THEN NULL "
        "ELSE CAST(l_quantity AS BIGINT) * 1000000 END AS weekly_hours_viewed",
        "CAST(greatest(1, floor(l_linenumber * l_quantity / 60)) AS INT) AS cumulative_weeks_in_top_10",
    ]),
    "titles": ("orders", [
        "'s' || CAST(o_orderkey AS STRING) AS show_id",
        "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'Order ã #' || CAST(o_orderkey AS STRING) "
        # some titles normalise alike
        "ELSE '  order #' || CAST(o_orderkey - CASE WHEN o_orderkey % 9 = 4 THEN 1 ELSE 0 END AS STRING) END AS title",
        "CASE o_orderstatus WHEN 'P' THEN 'nan' WHEN 'O' THEN 'TV Show' ELSE 'Movie' END AS type",
        "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' WHEN o_orderpriority = '3-MEDIUM' AND month(o_orderdate) = 12 "
        "THEN 'nan, Quarter 4' ELSE substring(o_orderpriority, 3) || ', Quarter ' || CAST(quarter(o_orderdate) AS STRING) "
        "|| ',Year ' || CAST(year(o_orderdate) AS STRING) END AS listed_in",
    ]),
    "patients": ("customer", [
        "c_custkey AS id",
        "20 + c_nationkey * 2 AS age",
        "CAST(length(c_mktsegment) % 2 AS INT) AS gender",
        "floor(c_acctbal / 25) / 10 AS bmi",
        "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS smoking",
        "CAST(length(c_mktsegment) % 3 AS INT) AS genetic_risk",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS diagnosis",
    ]),
    "scored": ("events", [
        "'event ' || CAST(event_id AS STRING) AS title_clean",
        "'Event ' || CAST(event_id AS STRING) AS show_title",
        "event_type AS type_clean",
        "'user ' || CAST(user_id AS STRING) AS primary_genre",
        "CAST(ts AS DATE) AS first_week_date",
        "CASE WHEN value >= 100 THEN 1.0E0 ELSE value / 100 END AS score",
        "CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS actual",
    ]),
    # the weekly feed as a file would hold it, every column text
    "weekly_text": ("lineitem", [
        "CAST(CAST(date_trunc('week', l_shipdate) AS DATE) AS STRING) AS week",
        "l_returnflag || l_linestatus AS category",
        "CASE WHEN l_tax = 0.08 THEN 'n/a' WHEN l_tax = 0.07 THEN ' ' || CAST(l_linenumber AS STRING) || ' ' "
        "ELSE CAST(l_linenumber AS STRING) || '.7' END AS weekly_rank",
        "'Order #' || CAST(l_orderkey AS STRING) AS show_title",
        "CASE WHEN l_discount = 0 THEN NULL ELSE 'Season ' || CAST(l_suppkey AS STRING) END AS season_title",
        "CAST(CAST(l_quantity AS BIGINT) * 1000000 AS STRING) AS weekly_hours_viewed",
        "CASE WHEN l_discount = 0.1 THEN '' ELSE CAST(l_discount AS STRING) END AS runtime",
        "CASE WHEN l_discount = 0.09 THEN 'inf' ELSE CAST(l_partkey AS STRING) END AS weekly_views",
        "CAST(l_linenumber AS STRING) AS cumulative_weeks_in_top_10",
        "CASE l_linenumber WHEN 1 THEN 'true' WHEN 2 THEN '1' WHEN 3 THEN ' T ' WHEN 4 THEN 'Yes' WHEN 5 THEN 'no' "
        "WHEN 6 THEN '' ELSE NULL END AS is_staggered_launch",
        "l_returnflag AS episode_launch_details",
    ]),
}


#: Rows of a table that one task gets: with a fixed number of tasks their sorts would grow with the table.
ROWS_A_TASK = 500_000
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: Rows of a file among which those of one key stay together.  A hot key fills no more than one task's share of each run.
RUN_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table.  The test files hold one row group each, so one task would read them: their rows are dealt out.

    At least one part a core, more if the table is large.  The count reads the footers of the files only.  Rows are
    dealt out by their first column and by the run of the file they stand in: those of one order that are near each other
    meet in one task, so first rows and group sums fold there, before the next shuffle.
    """
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size = rows.count()
    fit_shuffles(spark, size)
    # this session may not have been built by session.py
    spark.conf.set(METHOD_LIMIT, SETTINGS[METHOD_LIMIT])
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(size / ROWS_A_TASK))
    run = F.floor(F.col("_metadata.row_index") / RUN_ROWS)
    placed = rows.withColumn("__part", F.pmod(F.xxhash64(rows.columns[0], run), F.lit(parts)).cast("int"))
    return placed.repartitionById(parts, F.col("__part")).drop("__part")


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, expressions = FEEDS[name]
    rows = table(spark, sf_dir, source)
    if any(KEYWORD_NO in e for e in expressions):
        # the text repeats the number thirty times over: it is worked out once a row
        rows = rows.withColumn("__keyword", F.expr(KEYWORD_NO))
        expressions = [e.replace(KEYWORD_NO, "__keyword") for e in expressions]
    return rows.selectExpr(*expressions)


def feed_sql(name: str) -> str:
    source, expressions = FEEDS[name]
    return f"{name} AS (SELECT {', '.join(expressions)} FROM {source})"
