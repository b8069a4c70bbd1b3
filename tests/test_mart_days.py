"""A mart table loaded by days: only the interval's partitions change."""

import datetime as dt
import os

import pytest
from conftest import rows_of, ts

from cdcmart.functions.interval import Interval
from cdcmart.plans.jobs import run_extract, run_material_kg
from cdcmart.schemas import DEMAND_SCHEMA, MATERIAL_KG_SCHEMA
from cdcmart.sources.lake import read_interval, write_interval
from cdcmart.sources.tables import ensure_table, read_table, replace_days

TABLE = "mart_days_kg"


def files(spark, table):
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    root = place.replace("file:", "")
    return {d: sorted(f for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet"))
            for d in os.listdir(root) if d.startswith("date=")}


def mart(spark, *rows):
    return spark.createDataFrame([(dt.date(2024, 1, d), s, "robusta", q) for d, s, q in rows],
                                 "date date, shop_id string, raw_material string, demand_kg double").selectExpr(
        "date", "shop_id", "raw_material", "CAST(demand_kg AS decimal(38,7)) AS demand_kg")


@pytest.fixture
def table(spark):
    ensure_table(spark, TABLE, MATERIAL_KG_SCHEMA, replace=True, partition_by=("date",))
    yield TABLE
    spark.sql(f"DROP TABLE IF EXISTS {TABLE}")


def test_a_day_replaces_its_partition_alone(spark, table):
    replace_days(mart(spark, (1, "A", 1.0), (2, "A", 2.0), (3, "A", 3.0)), table, Interval.parse("2024-01-01", "2024-01-04"))
    before = files(spark, table)
    replace_days(mart(spark, (2, "B", 5.0)), table, Interval.day("2024-01-02"))
    after = files(spark, table)
    assert [d for d in before if before[d] != after[d]] == ["date=2024-01-02"]
    assert [(r["date"].day, r["shop_id"]) for r in spark.table(table).orderBy("date").collect()] == [(1, "A"), (2, "B"), (3, "A")]


def test_days_without_rows_go_and_other_days_are_refused(spark, table):
    replace_days(mart(spark, (1, "A", 1.0), (2, "A", 2.0), (3, "A", 3.0)), table, Interval.parse("2024-01-01", "2024-01-04"))
    replace_days(mart(spark, (1, "C", 1.0)), table, Interval.parse("2024-01-01", "2024-01-03"))
    assert rows_of(spark.table(table).select("shop_id")) == [("A",), ("C",)]
    replace_days(mart(spark), table, Interval.day("2024-01-03"))  # an empty load
    assert rows_of(spark.table(table).select("shop_id")) == [("C",)]
    with pytest.raises(ValueError, match="outside"):
        replace_days(mart(spark, (9, "A", 1.0)), table, Interval.day("2024-01-03"))


def test_a_table_that_is_not_partitioned_by_day_is_refused(spark):
    ensure_table(spark, "mart_flat_kg", MATERIAL_KG_SCHEMA, replace=True)
    with pytest.raises(ValueError, match="partitioned by"):
        replace_days(mart(spark, (1, "A", 1.0)), "mart_flat_kg", Interval.day("2024-01-01"))
    spark.sql("DROP TABLE mart_flat_kg")


def test_the_kg_job_run_again(spark, table, tmp_path):
    root, span = str(tmp_path / "lake"), Interval.parse("2024-01-01", "2024-01-03")
    one, two = ts("2024-01-01"), ts("2024-01-02")
    run_extract(spark.createDataFrame([("A", one, "cheap", "1"), ("A", two, "cheap", "2")], DEMAND_SCHEMA), root, span)
    run_material_kg(spark, root, span, table=table)
    first = rows_of(read_table(spark, table))
    run_material_kg(spark, root, span, table=table)
    assert rows_of(read_table(spark, table)) == first and len(first) == 6
    run_extract(spark.createDataFrame([("B", two, "medium", "7")], DEMAND_SCHEMA), root, Interval.day("2024-01-02"))
    run_material_kg(spark, root, Interval.day("2024-01-02"), table=table)
    got = {(str(r["date"]), r["shop_id"]) for r in read_table(spark, table).collect()}
    assert got == {("2024-01-01", "A"), ("2024-01-02", "B")}


def test_writing_days_computes_the_rows_once(spark, table, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(df):
        def one(row):
            seen.add(1)
            return row
        return spark.createDataFrame(df.rdd.map(one), df.schema)

    span, root = Interval.parse("2024-01-01", "2024-01-04"), str(tmp_path)
    rows = mart(spark, (1, "A", 1.0), (2, "A", 2.0), (3, "A", 3.0))
    write_interval(counted(rows), root, "kg", span)
    assert seen.value == 3
    replace_days(counted(rows), table, span)
    assert seen.value == 6
    write_interval(counted(rows.where("date != DATE '2024-01-02'")), root, "kg", span)  # a day without rows is emptied
    assert seen.value == 8
    assert rows_of(read_interval(spark, root, "kg", MATERIAL_KG_SCHEMA, span).selectExpr("day(date) AS d")) == [(1,), (3,)]


def test_a_load_with_a_row_of_another_day_changes_nothing(spark, table):
    span = Interval.parse("2024-01-01", "2024-01-03")
    replace_days(mart(spark, (1, "A", 1.0), (2, "A", 2.0)), table, span)
    with pytest.raises(ValueError, match="outside"):
        replace_days(mart(spark, (1, "B", 5.0), (9, "B", 5.0)), table, span)
    assert rows_of(read_table(spark, table).select("shop_id")) == [("A",), ("A",)]
