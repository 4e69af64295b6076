"""Session builder with the settings the library relies on."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

SETTINGS = {
    # runtime re-planning: coalesced shuffles, split hot join partitions, measured broadcasts
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # dates must not move with the machine's zone
    "spark.sql.session.timeZone": "UTC",
    # strict casts raise, lenient steps use the try_ functions
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # generated methods beyond this many bytes are never compiled by HotSpot: Spark then generates smaller ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # files in charsets that only the JVM knows
    "spark.sql.legacy.javaCharsets": "true",
}

#: Rows of the largest table for which a shuffle gets a part, and bytes of small parts that one task may take together.
ROWS_A_PART = 250_000
PART_BYTES = "16m"


def fit_shuffles(spark: SparkSession, rows: int) -> None:
    """Let the parts of the session's shuffles grow with the rows of its tables, so that a task's memory does not.

    The number of parts is only ever raised.  Adaptive execution joins small parts again, up to ``PART_BYTES`` unless
    the session names its own size: sorts and hash tables of a task take many times the bytes it reads.
    """
    parts, joined = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(parts, max(int(spark.conf.get(parts)), math.ceil(rows / ROWS_A_PART)))
    if spark.conf.get(joined, None) is None:
        spark.conf.set(joined, PART_BYTES)


def build_session(app_name: str = "gristmill", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session; ``extra`` holds further settings, dots written as ``__``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
