import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """The tables here are small; fewer shuffle partitions leave the results alone and the tests shorter."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
