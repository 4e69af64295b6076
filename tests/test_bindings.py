from pyspark.sql import functions as F

from checks import bindings
from gristmill import session

SMALL = "/root/testdata/sf0.001"


def test_parts_of_a_table_grow_with_its_rows(spark, monkeypatch):
    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert bindings.table(spark, SMALL, "lineitem").rdd.getNumPartitions() == cores
    monkeypatch.setattr(bindings, "ROWS_A_TASK", 500)
    table = bindings.table(spark, SMALL, "lineitem")
    assert table.rdd.getNumPartitions() == -(-rows.count() // 500) > cores
    assert table.exceptAll(rows).isEmpty() and table.count() == rows.count()


def test_rows_of_a_key_meet_in_one_task_of_a_run(spark, monkeypatch):
    def tasks_of_a_key():
        placed = bindings.table(spark, SMALL, "lineitem").withColumn("task", F.spark_partition_id())
        keys = placed.groupBy("l_orderkey").agg(F.count_distinct("task").alias("n"), F.count("*").alias("rows"))
        return keys.agg(F.max("n"), F.max("rows")).first()

    most, repeats = tasks_of_a_key()
    assert most == 1 < repeats
    monkeypatch.setattr(bindings, "RUN_ROWS", 1)  # a key that fills whole runs is spread all the same
    assert tasks_of_a_key()[0] > 1


def test_parts_of_shuffles_grow_with_the_rows(spark):
    parts = "spark.sql.shuffle.partitions"
    own = spark.conf.get(parts)
    try:
        session.fit_shuffles(spark, 10 * session.ROWS_A_PART)
        assert int(spark.conf.get(parts)) == max(10, int(own))
        session.fit_shuffles(spark, 100 * session.ROWS_A_PART + 1)
        session.fit_shuffles(spark, 1)
        assert int(spark.conf.get(parts)) == 101
    finally:
        spark.conf.set(parts, own)


def test_keyword_numbers_are_worked_out_once_a_row(spark, capsys):
    feed = bindings.feed(spark, SMALL, "raw_keywords")
    plain = bindings.table(spark, SMALL, "lineitem").selectExpr(*bindings.FEEDS["raw_keywords"][1])
    feed.explain()
    assert capsys.readouterr().out.count(" < 10.0)") == 1
    assert feed.schema == plain.schema and feed.exceptAll(plain).isEmpty() and plain.exceptAll(feed).isEmpty()


def test_methods_stay_small_enough_to_be_compiled(spark):
    bindings.table(spark, SMALL, "orders")
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
