"""Quoted CSV read by many tasks: the same rows as a whole-file reader, whatever the blocks."""

import csv

import pytest
from pyspark.sql import functions as F

from gristmill.sources import files, quoted_csv

HEADER = ["id", "text", "more"]


def write(path, rows, end="\n", charset="utf-8"):
    with open(path, "w", newline="", encoding=charset) as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(HEADER)
        writer.writerows(rows)
    return str(path)


def rows_of(n):
    texts = ["plain", "a, b", 'say "hi"', "two\nlines", '"\n"\n""', "end\r\nof", "  kept  ", "ünï", '"', "\n", ""]
    return [(i, texts[i % len(texts)] + ("" if i % 3 else "x" * (i % 40)), texts[(i * 7) % len(texts)] * (i % 4)) for i in range(n)]


@pytest.fixture
def small_blocks(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, str(size)) for k in keep]
    for k, v in keep.items():
        spark.conf.set(k, v)


def read(spark, path, **options):
    found = files.read_csv(spark, path, file_order=True, missing_texts=(), **options)
    return [tuple(r) for r in found.orderBy(*files.FILE_ORDER).select(*HEADER).collect()]


@pytest.mark.parametrize("size", [40, 333, 4096, 1 << 20])
def test_rows_do_not_depend_on_blocks(spark, tmp_path, small_blocks, size):
    rows = rows_of(150)
    path = write(tmp_path / "rows.csv", rows)
    small_blocks(size)
    assert read(spark, path) == [(str(i), a or None, b or None) for i, a, b in rows]


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = write(tmp_path / "rows.csv", rows_of(4000))
    small_blocks(16_384)
    found = quoted_csv._lines(spark, path).mapInArrow(lambda batches: batches, "file_path string, file_block long, line binary")
    assert found.rdd.getNumPartitions() >= 8
    assert len(read(spark, path)) == 4000


def test_several_files_and_line_ends(spark, tmp_path, small_blocks):
    rows = rows_of(60)
    write(tmp_path / "a.csv", rows[:40], end="\r\n")
    write(tmp_path / "b.csv", rows[40:])
    small_blocks(200)
    assert read(spark, str(tmp_path)) == [(str(i), a or None, b or None) for i, a, b in rows]


@pytest.mark.parametrize("charset, python", [("cp1252", "cp1252"), ("mac-roman", "mac_roman")])
def test_charsets(spark, tmp_path, small_blocks, charset, python):
    rows = [(i, f"Müller\n{i}", 'é "ß"') for i in range(30)]
    path = write(tmp_path / "rows.csv", rows, charset=python)
    small_blocks(100)
    assert read(spark, path, charset=charset) == [(str(i), a, b) for i, a, b in rows]


def test_same_as_the_reader_of_whole_files(spark, tmp_path, small_blocks):
    path = write(tmp_path / "rows.csv", rows_of(200))
    want = read(spark, path, split=False)
    small_blocks(128)
    assert read(spark, path) == want


def test_record_over_many_blocks(spark, tmp_path, small_blocks):
    rows = [(1, "a", "b"), (2, "line\n" * 400, "c"), (3, "d", "e\n" * 300)]
    path = write(tmp_path / "rows.csv", rows)
    small_blocks(64)
    assert read(spark, path) == [(str(i), a, b) for i, a, b in rows]


def test_stray_and_open_quotes_raise(spark, tmp_path):
    (tmp_path / "stray.csv").write_text('id,text,more\n1,5" disk,3" disk\n2,a,b\n')
    with pytest.raises(Exception, match="outside of a quoted field"):
        read(spark, str(tmp_path / "stray.csv"))
    (tmp_path / "open.csv").write_text('id,text,more\n1,a,"never closed\n2,a,b\n')
    with pytest.raises(Exception, match="not closed"):
        read(spark, str(tmp_path / "open.csv"))


def test_header_only_short_rows_and_given_names(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("id,text,more\n")
    assert read(spark, str(tmp_path / "empty.csv")) == []
    (tmp_path / "short.csv").write_text("id,text,more\n\n1,a\n2,b,c")
    assert read(spark, str(tmp_path / "short.csv")) == [("1", "a", None), ("2", "b", "c")]
    named = files.read_csv(spark, str(tmp_path / "short.csv"), header=["x", "y", "z"], columns=["z", "x"])
    assert sorted((r.x, r.z) for r in named.collect()) == [("1", None), ("2", "c")]


def test_no_shuffle_of_the_lines(spark, tmp_path):
    path = write(tmp_path / "rows.csv", rows_of(20))
    plan = quoted_csv.records(spark, path, "UTF-8").where(F.col("file_row") >= 0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_rows_of_blocks_are_not_dealt_out_to_a_fixed_number_of_parts(spark, tmp_path, capsys):
    path = files.export_csv(spark.range(100).selectExpr("id", "'a' || chr(10) || id AS t"), str(tmp_path / "many"))
    read = files.read_csv(spark, path, parts=2)
    read.explain()
    assert "REPARTITION_BY_NUM" not in capsys.readouterr().out
    assert read.count() == 100
    files.read_csv(spark, path, split=False, parts=2).explain()
    assert "REPARTITION_BY_NUM" in capsys.readouterr().out
