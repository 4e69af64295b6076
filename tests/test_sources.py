import datetime
import os
import uuid

import pytest
from pyspark.sql import functions as F

from gristmill import scratch
from gristmill.operators import quality
from gristmill.plans import modeling
from gristmill.sources import files, tables
from tests.conftest import rows


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_read_csv_quotes_breaks_markers_and_dates(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,title,day\n1,"a ""b"", c\nd",1995-10-30\n2,NaN,bad\n3,,\n')
    df = files.read_csv(spark, path, date_columns=["day"])
    assert rows(df) == [("1", 'a "b", c\nd', datetime.date(1995, 10, 30)), ("2", None, None), ("3", None, None)]
    assert df.dtypes == [("id", "string"), ("title", "string"), ("day", "date")]


def test_file_order_gives_first_rows(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,v\n" + "".join(f"{i % 5},{i}\n" for i in range(50)))
    df = files.read_csv(spark, path, file_order=True)
    ordered = df.orderBy(*files.FILE_ORDER).collect()
    assert [int(r["v"]) for r in ordered] == list(range(50))


@pytest.mark.parametrize("charset, codec", [("mac-roman", "mac_roman"), ("cp1252", "cp1252"), ("utf-8", "utf-8")])
def test_charsets(spark, tmp_path, charset, codec):
    path = write(tmp_path / "c.csv", "a\ncafé ÿ ü\n", codec)
    assert rows(files.read_csv(spark, path, charset=charset)) == [("café ÿ ü",)]
    assert rows(files.read_csv(spark, path, header=["a"], charset=charset)) == [("café ÿ ü",)]


def test_typed_load_keeps_first_show(spark, tmp_path):
    header = ",".join(f.name for f in tables.TITLES.fields)
    line = "{},Movie,{},d,c,US,2020,2020.0,PG,90 min,Dramas,x,90\n"
    path = write(tmp_path / "t.csv", header + "\n" + line.format("s1", "first é") + line.format("s1", "second") + line.format("s2", ""), "mac_roman")
    df = tables.load_csv_table(spark, path, tables.TITLES)
    assert rows(df, "show_id", "title", "release_year", "duration_value") == [("s1", "first é", 2020, 90), ("s2", None, 2020, 90)]
    assert dict(df.dtypes)["release_year"] == "int"


def test_health_load(spark, tmp_path):
    path = write(tmp_path / "h.csv", "Age,Gender,BMI,Smoking,GeneticRisk,PhysicalActivity,AlcoholIntake,CancerHistory,Diagnosis\n58,1,16.08,0,1,8.1,4.1,1,1\n,x,abc,,,,,,\n")
    df = tables.load_csv_table(spark, path, tables.HEALTH)
    assert rows(df) == [(58, 1, 16.08, 0, 1, 8.1, 4.1, 1, 1), (None,) * 9]
    stamped = tables.stamp(df, ["age", "bmi"])
    assert stamped.columns[0] == "id" and stamped.columns[-1] == "created_at"
    assert stamped.select("id").distinct().count() == 2


def test_insert_if_absent_and_counts(spark):
    target = spark.createDataFrame([("s1", "old")], "show_id string, title string")
    batch = spark.createDataFrame([("s1", "new", 1), ("s2", "b", 3), ("s2", "a", 2), (None, "x", 4)], "show_id string, title string, o int")
    assert rows(tables.insert_if_absent(target, batch, "show_id", [F.asc("o")]), "show_id", "title") == [("s2", "a")]
    assert rows(quality.load_counts({"t": target, "b": batch})) == [("b", 4), ("t", 1), ("total", 5)]


def test_named_tables(spark, tmp_path):
    name = "model_input_safe"
    row = {"title_clean": "a", "show_title": "A", "type_clean": "Movie", "primary_genre": "Drama", "first_week_date": datetime.date(2024, 1, 7),
           "first_season": "winter", "first_month_num": 1, "first_week_rank": 3, "first_week_hours_viewed": 5_000_000_000,
           "initial_rank_bucket": "top_3", "initial_hours_bucket": "high", "long_run_flag": 1}
    kinds = {"date": "date", "int": "int", "bigint": "bigint"}
    schema = ", ".join(f"{f.name} {kinds.get(f.kind, 'string')}" for f in tables.MODEL_TABLES[name].fields)
    source = spark.createDataFrame([tuple(row.values())], schema)
    path = files.export_csv(source, str(tmp_path / "safe.csv"))
    from_file, origin = tables.read_table_or_file(spark, name, path, "first_week_date")
    assert origin == "csv:safe.csv" and rows(from_file) == rows(source) and from_file.dtypes == source.dtypes
    assert rows(tables.replace_table(source, name)) == rows(source)
    from_table, origin = tables.read_table_or_file(spark, name, path, "first_week_date")
    assert origin == "db:model_input_safe" and from_table.dtypes == from_file.dtypes
    features = [modeling.columns_by_kind(df, modeling.feature_columns(df)) for df in (from_file, from_table)]
    assert features[0] == features[1] and "first_week_rank" in features[0][1]
    tables.append_table(source, name)
    assert spark.table(name).count() == 2
    assert tables.replace_table(source, name).count() == 1
    with pytest.raises(ValueError):
        tables.read_table(spark, "other")
    with pytest.raises(ValueError):
        tables.read_table_or_file(spark, "other", path, "first_week_date")
    spark.sql(f"DROP TABLE {name}")
    assert rows(tables.replace_view(source, "v_source")) == rows(source)


def test_reuse_or_build(spark, tmp_path):
    path, built = str(tmp_path / "stored"), spark.range(3)
    assert tables.reuse_or_build(spark, path, lambda: built).count() == 3
    files.write_parquet(spark.range(5), path)
    assert tables.reuse_or_build(spark, path, lambda: built).count() == 5
    files.export_csv(spark.range(2), str(tmp_path / "csv"))
    assert files.read_csv(spark, str(tmp_path / "csv")).count() == 2


def test_materialized_steps_go_to_the_shared_folder(spark):
    folder = scratch.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    step = scratch.materialize(spark.range(10), "x")
    place = step.inputFiles()[0]
    assert "/steps/x-" in place and step.count() == 10
    assert scratch.release(spark) >= 1 and scratch.release(spark) == 0
    assert not os.path.exists(place.removeprefix("file://"))


def test_without_checkpoint_folder_steps_go_to_the_warehouse(spark):
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return "file:/store/warehouse" if key == "spark.sql.warehouse.dir" else default

    assert scratch.shared_folder(Session) == "file:/store/warehouse/_steps"


def test_overlong_counts(spark):
    df = spark.createDataFrame([("s" * 11,), ("s",)], "show_id string")
    spec = tables.TableSpec("t", (tables.Field("show_id", limit=10),))
    assert rows(tables.overlong_counts(df, spec)) == [(1,)]


def test_overlong_text_raises(spark):
    spec = tables.TableSpec("t", (tables.Field("show_id", limit=10),))
    df = spark.createDataFrame([("s" * 11,)], "show_id string")
    assert tables.coerce(df, spec, enforce=False).count() == 1
    with pytest.raises(Exception, match="longer than 10"):
        tables.coerce(df, spec).collect()
    assert rows(tables.coerce(spark.createDataFrame([("s" * 10,), (None,)], "show_id string"), spec)) == [("s" * 10,), (None,)]


def test_serial_ids_have_no_gap_and_go_on(spark):
    batch = spark.createDataFrame([("same key", i % 3) for i in range(1000)], "key string, id2 int").repartition(7)
    first = tables.serial_ids(batch)
    assert first.columns == ["id", "key", "id2"] and sorted(r["id"] for r in first.collect()) == list(range(1, 1001))
    assert rows(first, "id") == rows(first, "id")
    more = tables.serial_ids(batch.limit(10), first)
    assert sorted(r["id"] for r in more.collect()) == list(range(1001, 1011))
    assert tables.serial_ids(batch.limit(0)).count() == 0
    plan = tables.serial_ids(batch)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan


def test_a_failed_replacement_leaves_the_old_rows(spark):
    name = f"replaced_{uuid.uuid4().hex}"
    old = spark.range(100).withColumn("note", F.lit("old"))
    tables.replace_table(old, name)
    late = F.when(F.col("id") == 90, F.raise_error(F.lit("half-way"))).otherwise(F.lit("new"))
    with pytest.raises(Exception, match="half-way"):
        tables.replace_table(spark.range(100).repartition(4).withColumn("note", late), name)
    assert rows(spark.table(name)) == rows(old)
    tables.replace_table(spark.table(name).where("id < 5"), name)  # also from its own rows
    tables.append_table(spark.range(5, 7).withColumn("note", F.lit("old")), name)
    assert rows(spark.table(name)) == rows(old.where("id < 7"))
    tables.replace_table(spark.range(3), name)  # other columns
    assert rows(spark.table(name)) == [(0,), (1,), (2,)]
    tables.replace_table(old, name, partition_by=["note"])
    assert spark.table(name).where("note = 'old'").count() == 100
    spark.sql(f"DROP TABLE {name}")
