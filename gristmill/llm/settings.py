"""Parameters that the queries and the pipeline share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SHARDS = 16
#: Quality scores below this are label 0.
THRESHOLD = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer() -> tuple[str, str]:
    """Path of the rank file and the split pattern of the tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def vocabulary(file: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(file)
