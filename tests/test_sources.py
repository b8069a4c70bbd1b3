"""CSV semantics, lake partitions, catalog tables and defaults."""

import datetime as dt

from conftest import plan_of, rows_of, ts
from pyspark.sql import functions as F

from cdcmart.functions.interval import Interval
from cdcmart.operators.keys import length_violations
from cdcmart.schemas import DEMAND_SCHEMA, RETAIL_COLUMNS, RETAIL_LENGTHS, RETAIL_SCHEMA
from cdcmart.sources.delimited import csv_writer, read_delimited
from cdcmart.sources.lake import interval_path, read_interval, read_partitioned, write_interval, write_partitioned
from cdcmart.sources.tables import (append, apply_defaults, clear, ensure_table, full_refresh, read_table,
                                    retail_defaults)

HEADER = ",".join(RETAIL_COLUMNS)


def write_text(path, text):
    path.write_text(text)
    return str(path)


def test_csv_null_empty_quotes_newlines(spark, tmp_path):
    text = (HEADER + "\n"
            '1,INV1,,"",5,2009-12-01 07:45:00,1.5,C1,NL,2009-12-01 07:45:00,I\n'
            '2,"a ""quoted"", word","multi\nline",x,6,2009-12-01 08:00:00,2.5,,"",2009-12-01 08:00:00,UU\n')
    p = write_text(tmp_path / "retail.csv", text)
    df = read_delimited(spark, p, RETAIL_SCHEMA)
    r1, r2 = sorted(df.collect(), key=lambda r: r["id"])
    assert r1["stockcode"] is None and r1["description"] == ""         # unquoted empty / quoted empty
    assert r2["invoice"] == 'a "quoted", word' and r2["stockcode"] == "multi\nline"
    assert r2["customer_id"] is None and r2["country"] == ""
    assert r2["operation"] == "UU"                                       # read; the length check flags it
    assert r1["invoicedate"] == ts("2009-12-01 07:45:00")
    got = {r["column"]: r["violations"] for r in length_violations(df, RETAIL_LENGTHS).collect()}
    assert got["operation"] == 1


def test_csv_ten_columns_no_header_and_long_text(spark, tmp_path):
    long = "x" * 101
    text = f"1,{long},S,D,5,2009-12-01 07:45:00,1.5,C1,NL,2009-12-01 07:45:00\n"
    p = write_text(tmp_path / "ten.csv", text)
    df = read_delimited(spark, p, RETAIL_SCHEMA, header=False, columns=RETAIL_COLUMNS[:-1])
    r = df.first()
    assert df.columns == list(RETAIL_COLUMNS)
    assert r["operation"] is None and r["invoice"] == long
    got = {x["column"]: x["violations"] for x in length_violations(df, RETAIL_LENGTHS).collect()}
    assert got["invoice"] == 1


def test_csv_non_numeric_demand_is_text(spark, tmp_path):
    p = write_text(tmp_path / "d.csv", "shop_id,date,product_name,demand\nS1,2009-12-01 00:00:00,cheap,ten\n")
    assert read_delimited(spark, p, DEMAND_SCHEMA).first()["demand"] == "ten"


def test_csv_write_read_round_trip_keeps_null_vs_empty(spark, tmp_path):
    df = spark.createDataFrame([("S1", ts("2009-12-01 10:00:00.123456"), "", None),
                                (None, ts("2009-12-01 00:00:00"), 'say "hi", ok', "1.5")], DEMAND_SCHEMA)
    out = str(tmp_path / "rt")
    csv_writer(df.coalesce(1)).save(out)
    back = read_delimited(spark, out, DEMAND_SCHEMA)
    assert rows_of(back) == rows_of(df)


def test_write_interval_replaces_only_its_day(spark, tmp_path):
    root = str(tmp_path / "lake")
    d1, d2 = ts("2009-12-01 08:00"), ts("2009-12-02 08:00")
    df = spark.createDataFrame([("S1", d1, "cheap", "1"), ("S2", d2, "cheap", "2")], DEMAND_SCHEMA)
    write_partitioned(df, root, "demand", "date")
    day1 = Interval.day("2009-12-01")
    write_interval(df, root, "demand", day1)           # rerun: same rows, no duplicates
    write_interval(df, root, "demand", day1)
    assert rows_of(read_partitioned(spark, root, "demand", DEMAND_SCHEMA)) == rows_of(df)
    # the day now has no rows: the rerun empties it, day 2 untouched
    write_interval(df.where("shop_id = 'S2'"), root, "demand", day1)
    assert rows_of(read_partitioned(spark, root, "demand", DEMAND_SCHEMA), "shop_id") == [("S2",)]
    got = read_interval(spark, root, "demand", DEMAND_SCHEMA, Interval.day("20091202"))
    assert rows_of(got, "shop_id") == [("S2",)]
    assert "PartitionFilters" in plan_of(got)
    assert interval_path(day1) == "2009/12"
    assert (tmp_path / "lake" / "demand" / "year=2009" / "month=12" / "ds=2009-12-02").is_dir()


def test_tables_lifecycle_and_defaults(spark, tmp_path):
    name = "wh_test.retail"
    ensure_table(spark, name, RETAIL_SCHEMA, replace=True,
                 defaults={"invoicedate": "CAST(current_date() AS TIMESTAMP_NTZ)"})
    ensure_table(spark, name, RETAIL_SCHEMA)  # IF NOT EXISTS: no error, no change
    rows = spark.createDataFrame([(1, "a", "s", "d", 1, ts("2009-12-01 00:00"), 1.0, "c", "n",
                                   ts("2009-12-01 00:00"), "I")], RETAIL_SCHEMA)
    append(rows, name)
    append(rows, name)  # no dedupe
    assert read_table(spark, name).count() == 2
    sliced = read_table(spark, name, Interval.day("2009-12-01"), "invoicedate")
    assert sliced.count() == 2
    assert read_table(spark, name, Interval.day("2009-12-02"), "invoicedate").count() == 0
    assert "PushedFilters: [IsNotNull(invoicedate), GreaterThanOrEqual(invoicedate" in \
        plan_of(sliced)
    clear(spark, name)
    assert read_table(spark, name).count() == 0
    p = write_text(tmp_path / "seed.csv", HEADER + "\n2,b,s,d,2,2009-12-02 00:00:00,2.0,c,n,2009-12-02 00:00:00,U\n")
    full_refresh(spark, p, name, RETAIL_SCHEMA)
    assert rows_of(read_table(spark, name), "id", "operation") == [(2, "U")]
    loaded = apply_defaults(rows.drop("invoicedate", "last_updated"), RETAIL_SCHEMA, retail_defaults())
    r = loaded.first()
    today = dt.datetime.combine(dt.date.today(), dt.time())
    assert loaded.columns == list(RETAIL_COLUMNS)
    assert r["invoicedate"] == r["last_updated"] == today or abs((r["invoicedate"] - today).days) <= 1
    spark.sql(f"DROP TABLE {name}")


def test_default_applies_only_to_omitted_columns(spark):
    df = spark.createDataFrame([(1, None)], "id int, invoicedate timestamp_ntz")
    out = apply_defaults(df, RETAIL_SCHEMA, retail_defaults())
    r = out.first()
    assert r["invoicedate"] is None and r["last_updated"] is not None
    assert out.where(F.col("operation").isNull()).count() == 1


def test_write_partitioned_without_shuffle(spark, tmp_path):
    root = str(tmp_path / "lake")
    df = spark.createDataFrame([("S1", ts("2009-12-01 08:00"), "cheap", "1"), ("S2", ts("2009-12-02 08:00"), "x", "2")],
                               DEMAND_SCHEMA)
    write_partitioned(df, root, "demand", "date", rebalance=False)
    assert rows_of(read_partitioned(spark, root, "demand", DEMAND_SCHEMA)) == rows_of(df)


def test_multi_day_interval_write_and_read(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = [("S1", ts("2009-12-01 08:00"), "a", "1"), ("S2", ts("2009-12-02 08:00"), "b", "2"),
            ("S3", ts("2009-12-03 08:00"), "c", "3")]
    df = spark.createDataFrame(rows, DEMAND_SCHEMA)
    write_partitioned(df, root, "demand", "date")
    changed = spark.createDataFrame([("S1x", ts("2009-12-01 09:00"), "a", "9"), ("S2x", ts("2009-12-02 09:00"), "b", "9"),
                                     ("S3x", ts("2009-12-03 09:00"), "c", "9")], DEMAND_SCHEMA)
    write_interval(changed, root, "demand", Interval.parse("2009-12-01", "2009-12-03"))  # days 1-2 replaced
    assert rows_of(read_partitioned(spark, root, "demand", DEMAND_SCHEMA), "shop_id") == [("S1x",), ("S2x",), ("S3",)]
    two = read_interval(spark, root, "demand", DEMAND_SCHEMA, Interval.parse("20091202", "20091204"))
    assert rows_of(two, "shop_id") == [("S2x",), ("S3",)]


def test_parquet_lake_round_trip_and_day_replace(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = [("S1", ts("2009-12-01 08:00"), "a", "1"), ("S2", ts("2009-12-02 08:00"), None, "2")]
    df = spark.createDataFrame(rows, DEMAND_SCHEMA)
    write_partitioned(df, root, "demand", "date", fmt="parquet")
    redo = spark.createDataFrame([("S9", ts("2009-12-02 09:00"), "b", "7")], DEMAND_SCHEMA)
    write_interval(redo, root, "demand", Interval.day("2009-12-02"), fmt="parquet")
    back = read_partitioned(spark, root, "demand", DEMAND_SCHEMA, fmt="parquet")
    assert rows_of(back, "shop_id", "product_name") == [("S1", "a"), ("S9", "b")]
    assert rows_of(read_interval(spark, root, "demand", DEMAND_SCHEMA, Interval.day("2009-12-01"), fmt="parquet"),
                   "shop_id") == [("S1",)]
