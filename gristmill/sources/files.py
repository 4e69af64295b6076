"""Delimited files in and out.

Raw files are read as text and coerced column by column afterwards; nothing is
inferred from the data.  Files with quoted line breaks are read block by block
(``quoted_csv``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.casting import to_day
from gristmill.sources.quoted_csv import fields, records

# Texts that table readers take for missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Legacy charset names and what the JVM calls them.
CHARSETS = {"utf-8": "UTF-8", "mac-roman": "x-MacRoman", "cp1252": "windows-1252"}
# Columns that give the original row order of a file; a keep-first step sorts by them.
FILE_ORDER = ("file_path", "file_block", "file_row")


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    date_columns: Sequence[str] = (),
    charset: str = "utf-8",
    multi_line: bool = True,
    split: bool = True,
    missing_texts: Sequence[str] = MISSING_TEXTS,
    file_order: bool = False,
    header: Sequence[str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Header CSV as text columns, with missing markers as NULL and the listed columns as dates.

    ``columns`` selects by header name.  ``header`` gives the names of the header
    line, so that no file is opened before the query runs.  ``file_order`` adds the
    columns of ``FILE_ORDER``.  ``multi_line`` allows quoted line breaks.  With
    ``split`` each block of a file is a task of its own, so their number grows with the file and ``parts`` is not
    needed; quotes may then stand around whole fields only.  Without it one task reads a whole file, and
    ``parts`` deals its rows out before they are parsed further.  Charsets beyond
    the built-in ones need the session setting of ``session.SETTINGS``.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    java_charset = CHARSETS.get(charset.lower(), charset)
    reader = reader.option("encoding", java_charset)
    if multi_line and split and not java_charset.upper().startswith("UTF-16") and not java_charset.upper().startswith("UTF-32"):
        every = list(header or reader.csv(path).columns)
        found = records(spark, path, java_charset).where("file_block <> 0 OR file_row <> 0")
        raw = found.select(*FILE_ORDER, fields(F.col("record"), every).alias("__record")).select(*FILE_ORDER, *(F.col(f"__record.`{c}`") for c in every))
        return _cleaned(raw, list(columns or every), missing_texts, date_columns, [F.col(c) for c in FILE_ORDER] if file_order else [], None)
    if header:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in header]))
    raw = reader.csv(path)
    order: list[Column] = []
    if file_order:
        order = [
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("file_block"),
            F.monotonically_increasing_id().alias("file_row"),
        ]
    return _cleaned(raw, list(columns or raw.columns), missing_texts, date_columns, order, parts)


def _cleaned(raw: DataFrame, names: list[str], missing_texts: Sequence[str], date_columns: Sequence[str], order: list[Column], parts: int | None) -> DataFrame:
    """The named text columns with NULL for missing markers, and dates."""
    markers = [m for m in missing_texts if m]
    text = [F.when(~F.col(f"`{c}`").isin(markers), F.col(f"`{c}`")).alias(c) if markers else F.col(c) for c in names]
    df = raw.select(*text, *order)
    df = df.repartition(parts) if parts else df
    return df.withColumns({c: to_day(F.col(c)) for c in date_columns}) if date_columns else df


def write_parquet(df: DataFrame, path: str) -> str:
    """Drop-and-replace a Parquet result; keys and pivot indexes are ordinary columns."""
    df.write.mode("overwrite").parquet(path)
    return path


def export_csv(df: DataFrame, path: str, charset: str = "utf-8") -> str:
    """Drop-and-replace a CSV export with header, one file per partition."""
    encoding = CHARSETS.get(charset.lower(), charset)
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", encoding)
    # the writer would trim values otherwise
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path
