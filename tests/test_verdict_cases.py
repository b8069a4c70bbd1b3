"""Cases once found wrong: reruns, exact numbers, text dates, first loads."""


import pytest
from conftest import plan_of, retail, rows_of, ts

from cdcmart.functions.interval import Interval, in_interval
from cdcmart.functions.recipes import demand_number
from cdcmart.operators.keys import ConstraintViolation
from cdcmart.operators.merge import apply_changes
from cdcmart.sources.lake import write_interval
from cdcmart.sources.snapshots import SnapshotStore

DAY1, DAY2 = ts("2009-12-01 10:00"), ts("2009-12-02 10:00")


def test_interval_rerun_drops_a_day_that_is_now_empty(spark, tmp_path):
    rows = spark.createDataFrame([(1, DAY1), (2, DAY2)], "id int, date timestamp_ntz")
    span = Interval.parse("2009-12-01", "2009-12-03")
    write_interval(rows, str(tmp_path), "d", span, fmt="parquet")
    write_interval(rows.where("id = 1"), str(tmp_path), "d", span, fmt="parquet")
    assert spark.read.parquet(f"{tmp_path}/d").count() == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_demand_is_exact_or_bad(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        ok = spark.createDataFrame([("1.2500",), (None,), ("7",)], "demand string")
        assert [r[0] if r[0] is None else float(r[0]) for r in ok.select(demand_number()).collect()] == [1.25, None, 7.0]
        for bad in ("0.00004", "x", ""):
            df = spark.createDataFrame([(bad,)], "demand string")
            assert df.select(demand_number(strict=False)).first()[0] is None
            with pytest.raises(Exception, match="not an exact demand"):
                df.select(demand_number()).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_text_dates_are_sliced_as_times(spark):
    df = spark.createDataFrame([("2009-12-01",), ("2009-12-01 23:59:59",), ("2009-12-02",)], "d string")
    assert rows_of(in_interval(df, Interval.day("2009-12-01"), "d")) == [("2009-12-01",), ("2009-12-01 23:59:59",)]


def test_two_changes_for_one_key_raise(spark):
    target = retail(spark, [(1, "a", 1, DAY1, DAY1, None)])
    changes = retail(spark, [(1, "b", 2, DAY1, DAY1, "U"), (1, "c", 3, DAY1, DAY2, "U")])
    with pytest.raises(ConstraintViolation):
        apply_changes(target, changes)


def test_first_load_broadcasts_no_insert_keys(spark):
    target = retail(spark, [(1, "a", 1, DAY1, DAY1, None)])
    changes = retail(spark, [(i, "n", 1, DAY1, DAY1, "I") for i in range(2, 400)] + [(1, "u", 9, DAY1, DAY1, "U")])
    merged = apply_changes(target, changes, broadcast_limit_bytes=1000)
    assert "LeftSemi, BuildRight" not in plan_of(merged)
    assert merged.count() == 399


def test_publishing_an_old_folder_again_makes_it_the_newest(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    one = store.write(spark.range(1), "2009-12-01")
    store.write(spark.range(2), "2009-12-02")
    store.publish("2009-12-02", one)
    assert store.path("2009-12-02") == one and store.read("2009-12-02").count() == 1


def test_an_unreadable_record_is_not_an_empty_store(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.path("2009-12-01") is None
    store.write(spark.range(1), "2009-12-01")
    (tmp_path / "_published" / "part-x.json.gz").write_bytes(b"not gzip")
    with pytest.raises(Exception):
        store.path("2009-12-01")
