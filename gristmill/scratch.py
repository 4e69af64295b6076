"""Intermediate tables in a folder that all executors share.

A step that has to be computed once and read several times is written here as
Parquet.  The written copy survives the loss of executors, gives every reader
the same rows, and tells the planner its true size, so joins against it are
broadcast only when it really is small.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder in the warehouse, which executors share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_steps"


def step_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder for something other than a table; ``release`` deletes it."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written table."""
    spark = df.sparkSession
    path = step_path(spark, label)
    df.write.parquet(path)
    step = spark.read.schema(df.schema).parquet(path)
    step._step_path = path
    return step


def discard(*steps: DataFrame) -> None:
    """Delete written steps before the end: only those that ``materialize`` returned and whose every reader is itself written."""
    for step in steps:
        spark = step.sparkSession
        _written[spark.sparkContext.applicationId].remove(step._step_path)
        _delete(spark, [step._step_path])


def release(spark: SparkSession) -> int:
    """Delete every step this session has written; call it when the results that read them are stored.  Returns how many."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    _delete(spark, paths)
    return len(paths)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(hadoop).delete(where, True)
