"""Declared tables: typed loads, append-if-absent, named reads and fallbacks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.functions.casting import to_day, to_flag, to_real, to_whole
from gristmill.operators.cleaning import keep_first
from gristmill.scratch import materialize
from gristmill.sources.files import read_csv


def _text(column: Column) -> Column:
    """Text stays as it is; missing stays NULL."""
    return column.cast("string")


def _day(column: Column) -> Column:
    return to_day(column)


def _int(column: Column) -> Column:
    return to_whole(column).try_cast("int")


COERCIONS: Mapping[str, Callable[[Column], Column]] = {
    "text": _text, "int": _int, "bigint": to_whole, "double": to_real, "boolean": to_flag, "date": _day,
}


@dataclass(frozen=True)
class Field:
    """One column of a declared table: its name, kind, header in the file and greatest length."""

    name: str
    kind: str = "text"
    source: str | None = None
    limit: int | None = None


@dataclass(frozen=True)
class TableSpec:
    """Declared table: fields, the file charset and the unique key, if any."""

    name: str
    fields: tuple[Field, ...]
    charset: str = "utf-8"
    unique: str | None = None


# Types, lengths, headers and charsets of the files that are loaded.
HEALTH = TableSpec("health", (
    Field("age", "int", "Age"),
    Field("gender", "int", "Gender"),
    Field("bmi", "double", "BMI"),
    Field("smoking", "int", "Smoking"),
    Field("genetic_risk", "int", "GeneticRisk"),
    Field("physical_activity", "double", "PhysicalActivity"),
    Field("alcohol_intake", "double", "AlcoholIntake"),
    Field("cancer_history", "int", "CancerHistory"),
    Field("diagnosis", "int", "Diagnosis"),
))
TITLES = TableSpec("titles", (
    Field("show_id", limit=10),
    Field("type", limit=50),
    Field("title", limit=500),
    Field("director"),
    Field("cast"),
    Field("country", limit=255),
    Field("date_added", limit=50),
    Field("release_year", "int"),
    Field("rating", limit=20),
    Field("duration", limit=50),
    Field("listed_in"),
    Field("description"),
    Field("duration_value", "int"),
), charset="mac-roman", unique="show_id")
WEEKLY = TableSpec("weekly_chart", (
    Field("week", "date"),
    Field("category", limit=50),
    Field("weekly_rank", "int"),
    Field("show_title", limit=500),
    Field("season_title", limit=255),
    Field("weekly_hours_viewed", "bigint"),
    Field("runtime", "double"),
    Field("weekly_views", "bigint"),
    Field("cumulative_weeks_in_top_10", "int"),
    Field("is_staggered_launch", "boolean"),
    Field("episode_launch_details"),
), charset="cp1252")
MART = TableSpec("genre_mart", (
    Field("week_date", "date"),
    Field("month_num", "int"),
    Field("season", limit=50),
    Field("title_clean", limit=500),
    Field("show_title", limit=500),
    Field("weekly_rank_num", "int"),
    Field("weekly_hours_viewed_num", "bigint"),
    Field("cumulative_weeks_in_top_10_num", "int"),
    Field("type_clean", limit=50),
    Field("genre"),
))
_SAFE_FIELDS = (
    Field("title_clean"), Field("show_title"), Field("type_clean"), Field("primary_genre"), Field("first_week_date", "date"),
    Field("first_season"), Field("first_month_num", "int"), Field("first_week_rank", "int"), Field("first_week_hours_viewed", "bigint"),
    Field("initial_rank_bucket"), Field("initial_hours_bucket"), Field("long_run_flag", "int"),
)
_RUN_FIELDS = (Field("weeks_in_top10", "bigint"), Field("best_rank", "int"), Field("max_cumulative_weeks", "int"))
#: Tables that may be read by name, with the types their CSV copies are read in.
MODEL_TABLES = {
    "model_input_safe": TableSpec("model_input_safe", _SAFE_FIELDS),
    "model_input_leakage": TableSpec("model_input_leakage", _SAFE_FIELDS + _RUN_FIELDS),
}


def coerce(raw: DataFrame, spec: TableSpec, enforce: bool = True) -> DataFrame:
    """Text columns to the declared types, one projection for all rows; a text longer than declared raises if ``enforce``."""

    def typed(field: Field) -> Column:
        value = COERCIONS[field.kind](F.col(f"`{field.source or field.name}`"))
        if field.limit and enforce:
            problem = F.concat(F.lit(f"{spec.name}.{field.name} is longer than {field.limit}: "), F.left(value, F.lit(80)))
            value = F.when(F.length(value) > field.limit, F.raise_error(problem)).otherwise(value)
        return value.alias(field.name)

    return raw.select(*[typed(f) for f in spec.fields])


def overlong_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: per limited text column, how many values exceed the declared length."""
    limited = [f for f in spec.fields if f.limit]
    return df.agg(*[F.count_if(F.length(f.name) > f.limit).alias(f.name) for f in limited])


def stamp(df: DataFrame, keys: Sequence[str], id_column: str = "id") -> DataFrame:
    """Add a surrogate id (hash of the business key: stable across reloads) and the load time.

    A 64-bit hash: rows that share the key share the id, and among five billion keys some two are likely to.  Where the
    id has to be unique, use ``serial_ids``.
    """
    return df.select(F.xxhash64(*keys).alias(id_column), "*", F.current_timestamp().alias("created_at"))


def serial_ids(batch: DataFrame, target: DataFrame | None = None, id_column: str = "id") -> DataFrame:
    """Add ids without gap or repeat, continued behind the largest id of ``target``; rows that are equal get ids of their own.

    No sort and no shuffle of the rows: they are written once, each with its place in its task, and a task's ids begin
    behind the rows of the tasks before it.  One short row per task is broadcast.
    """
    start = (target.agg(F.max(id_column)).first()[0] or 0) if target is not None else 0
    placed = materialize(batch.withColumn("__place", F.monotonically_increasing_id()), "placed")
    task, row = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(task.alias("__task")).agg(F.count("*").alias("__rows"))
    begins = sizes.select("__task", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    joined = placed.withColumn("__task", task).join(F.broadcast(begins), "__task")
    return joined.select((F.lit(start + 1) + F.col("__before") + row).cast("bigint").alias(id_column), *[F.col(f"`{c}`") for c in batch.columns])


def load_csv_table(
    spark: SparkSession, path: str, spec: TableSpec, order: Sequence[str] | None = None, enforce: bool = True
) -> DataFrame:
    """Read a file in its charset and coerce it to a declared table; a unique key keeps its first row."""
    raw = read_csv(spark, path, charset=spec.charset, file_order=spec.unique is not None)
    if spec.unique:
        columns = list(order or ("file_path", "file_block", "file_row"))
        raw = keep_first(raw, [spec.unique], [F.col(c).asc() for c in columns])
    return coerce(raw, spec, enforce)


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The rows of a batch to append: first of each key, and only keys the target lacks."""
    first = keep_first(batch.where(F.col(key).isNotNull()), [key], order)
    return first.join(target.select(key), key, "left_anti")


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Drop-and-replace a stored table; until the new rows are whole, readers find the old ones, also after a failed write.

    The rows are written beside the old ones, then the table is pointed at them.  Only a table of other columns or
    partitions has to be dropped and made anew, after the write.  The version before stays for those who still read it,
    older ones are deleted.
    """
    spark = df.sparkSession
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_versions/{name}"
    path = f"{root}/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    written = spark.read.parquet(path)
    known = spark.catalog.tableExists(name)
    columns = lambda t: [(f.name, f.dataType) for f in t.schema.fields]
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition] if known else []
    if known and columns(spark.table(name)) == columns(written) and partitions == list(partition_by) and not partitions:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path, "parquet")
        if partition_by:
            spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    _delete_versions(spark, root)
    return spark.table(name)


def _delete_versions(spark: SparkSession, root: str) -> None:
    """Keep the two newest versions of a table."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(hadoop)
    for status in sorted(system.listStatus(folder), key=lambda s: -s.getModificationTime())[2:]:
        system.delete(status.getPath(), True)


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """Session-scoped named step; lazy, so persist it when several queries read it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append rows to a stored table."""
    df.write.mode("append").format("parquet").saveAsTable(name)


def read_table(spark: SparkSession, name: str, allowed: Collection[str] = MODEL_TABLES) -> DataFrame:
    """Read a stored table whose name is on the allow-list."""
    if name not in allowed:
        raise ValueError(f"unexpected table name: {name}")
    return spark.table(name)


def read_table_or_file(
    spark: SparkSession, name: str, path: str, date_column: str, allowed: Mapping[str, TableSpec] = MODEL_TABLES
) -> tuple[DataFrame, str]:
    """The stored table if it exists, else the CSV copy in the declared types; second value tells which one it was."""
    if name not in allowed:
        raise ValueError(f"unexpected table name: {name}")
    if spark.catalog.tableExists(name):
        df, source = read_table(spark, name, allowed), f"db:{name}"
    else:
        df, source = coerce(read_csv(spark, path), allowed[name]), f"csv:{path.rstrip('/').rsplit('/', 1)[-1]}"
    return df.withColumn(date_column, F.to_date(F.col(date_column).cast("string"))), source


def reuse_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read a stored Parquet result, or build it when there is none.  Does not write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return build()
