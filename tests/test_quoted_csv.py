"""Multi-line CSV read in splits equals the one-task read."""

import random

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.sources import quoted
from cdcmart.sources.delimited import csv_writer, read_delimited
from cdcmart.sources.quoted import read_records, split_states

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("note", T.StringType())])


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "300")
    yield
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def rows(n=400):
    rng = random.Random(4)
    part = ["a", "b,c", '"', '""', "\n", "\r\n", "é🙂", " ", "long word " * 8, '"\n"', "line\n\nline"]
    text = lambda: rng.choice([None, "", "".join(rng.choices(part, k=rng.randint(1, 12)))])
    out = [(i, text(), text()) for i in range(n)]
    return out + [(n, "x\n" * 1000, "a field over many splits"), (n + 1, '"\n' * 500, None)]


@pytest.mark.parametrize("header", [True, False])
def test_splits_equal_whole_files(spark, tmp_path, small_splits, header):
    path, data = str(tmp_path / "csv"), rows()
    csv_writer(spark.createDataFrame(data, SCHEMA).coalesce(2), header=header).save(path)
    got = read_delimited(spark, path, SCHEMA, header=header, multiline="split")
    whole = read_delimited(spark, path, SCHEMA, header=header)
    assert rows_of(got) == rows_of(whole) == rows_of(spark.createDataFrame(data, SCHEMA))
    lines = quoted._lines(spark, path)
    assert lines.select("__file", "__start").distinct().count() > 20
    states = split_states(lines)
    assert states.where("begins AND ends").count() > 3  # splits wholly inside a field
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan


def test_more_open_splits_than_fit_a_broadcast(spark, tmp_path, small_splits, monkeypatch):
    path, data = str(tmp_path / "csv"), rows(120)
    csv_writer(spark.createDataFrame(data, SCHEMA).coalesce(1)).save(path)
    monkeypatch.setattr(quoted, "fits_broadcast", lambda df: False)
    assert rows_of(read_delimited(spark, path, SCHEMA, multiline="split")) == rows_of(spark.createDataFrame(data, SCHEMA))


def test_line_ends_blank_lines_and_open_quote(spark, tmp_path, small_splits):
    path = tmp_path / "a.csv"
    path.write_bytes(b'id,text,note\r\n1,"a\r\nb",c\r\n\r\n2,,""\r\n\n3,"x ""y"" z",\r\n')
    assert rows_of(read_delimited(spark, str(path), SCHEMA, multiline="split")) == [
        (1, "a\r\nb", "c"), (2, None, ""), (3, 'x "y" z', None)]
    path.write_bytes(b'id,text,note\n1,"never closed\n2,b,c\n' + b"3,d,e\n" * 200)
    assert read_records(spark, str(path)).where("NOT first").count() == 1
    path.write_bytes(b"")
    assert read_records(spark, str(path)).count() == 0


def test_partition_columns_and_bad_records(spark, tmp_path, small_splits):
    for day in ("2024-01-01", "2024-01-02"):
        folder = tmp_path / "lake" / f"ds={day}"
        folder.mkdir(parents=True)
        (folder / "a.csv").write_text("id,text,note\n" + f'1,"{day}\n{"t" * 700}",n\n' + "2,b,c\n" * 50)
    got = read_delimited(spark, str(tmp_path / "lake"), SCHEMA, multiline="split", keep_partition_columns=True)
    assert got.where("id = 1").select(F.col("ds").cast("string"), F.left("text", F.lit(10))).distinct().count() == 2
    day = read_records(spark, str(tmp_path / "lake"), lambda df: df["ds"] == "2024-01-02")
    assert day.where("NOT first").count() == 51 and "PartitionFilters: [isnotnull(ds" in plan_of(day)
    assert got.groupBy("ds").count().where("count = 51").count() == 2
    (tmp_path / "bad.csv").write_text("id,text,note\nx,b,c\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_delimited(spark, str(tmp_path / "bad.csv"), SCHEMA, multiline="split").collect()
