"""Latest per key, intervals, and what the physical plans look like."""

import pytest
from conftest import SF_SMALL, plan_of, retail, rows_of, ts

from cdcmart.functions.interval import Interval, days, in_interval, parse_date
from cdcmart.operators.latest import first_per_key, latest_per_key
from cdcmart.operators.materials import material_demand
from cdcmart.operators.merge import apply_changes
from cdcmart.plans import fixtures as fx


def test_parse_both_spellings():
    assert parse_date("2009-12-01") == parse_date("20091201")
    iv = Interval.parse("2009-12-01", "20091202")
    assert (iv.ds, iv.ds_nodash) == ("2009-12-01", "20091201")
    assert [d.ds for d in days("2009-12-01", "2009-12-04")] == ["2009-12-01", "2009-12-02", "2009-12-03"]
    with pytest.raises(ValueError):
        parse_date("12/01/2009")
    with pytest.raises(ValueError):
        Interval.parse("2009-12-02", "2009-12-01")


def test_interval_is_half_open(spark):
    df = retail(spark, [(1, "at start", 1, ts("2009-12-01 00:00:00"), ts("2009-12-01 00:00"), None),
                        (2, "inside", 1, ts("2009-12-01 23:59:59.999999"), ts("2009-12-01 00:00"), None),
                        (3, "at end", 1, ts("2009-12-02 00:00:00"), ts("2009-12-01 00:00"), None)])
    got = rows_of(in_interval(df, Interval.day("20091201")), "invoice")
    assert got == [("at start",), ("inside",)]


def test_latest_picks_newest_and_nulls_first(spark):
    df = retail(spark, [(1, "old", 1, ts("2024-01-01 00:00"), ts("2024-01-01 01:00"), "U"),
                        (1, "new", 1, ts("2024-01-01 00:00"), ts("2024-01-01 02:00"), "D"),
                        (2, "dated", 1, ts("2024-01-01 00:00"), ts("2024-01-01 02:00"), "U"),
                        (2, "undated", 1, ts("2024-01-01 00:00"), None, "U")])
    got = rows_of(latest_per_key(df), "id", "invoice")
    # DESC puts NULL first, as the database orders it
    assert got == [(1, "new"), (2, "undated")]


def test_tie_break_makes_ties_deterministic(spark):
    t = ts("2024-01-01 01:00")
    df = retail(spark, [(1, "a", 1, t, t, "U"), (1, "b", 1, t, t, "U"), (1, "c", 1, t, t, "U")])
    assert rows_of(latest_per_key(df, tie_break="invoice"), "invoice") == [("c",)]


def test_first_per_key_equals_latest_per_key(spark):
    stage = fx.stage_o(spark, SF_SMALL)
    a = latest_per_key(stage)
    b = first_per_key(stage)
    assert rows_of(a) == rows_of(b.select(*a.columns))


def test_hot_key_reduced_before_shuffle(spark):
    # a third of all rows share one id; the partial WindowGroupLimit keeps one per task
    stage = fx.stage_o(spark, SF_SMALL)
    from pyspark.sql import functions as F
    hot = stage.withColumn("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")))
    latest = latest_per_key(hot)
    assert latest.where("id = 0").count() == 1
    txt = plan_of(latest)
    assert "WindowGroupLimit" in txt
    assert txt.index("WindowGroupLimit") < txt.rindex("Exchange") or "Partial" in txt


def test_interval_filter_reaches_parquet_scan(spark):
    df = in_interval(fx.table(spark, SF_SMALL, "events"), Interval.day("2024-01-03"), "ts")
    txt = plan_of(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in txt and "LessThan(ts," in txt


def test_projection_prunes_columns(spark):
    df = fx.table(spark, SF_SMALL, "events").select("event_id", "ts")
    txt = plan_of(df)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in txt


def test_broadcast_merge_does_not_shuffle_target(spark):
    target = fx.origin_o(spark, SF_SMALL)
    latest = latest_per_key(fx.stage_o(spark, SF_SMALL))
    out = apply_changes(target, latest, strategy="broadcast")
    txt = plan_of(out)
    assert "BroadcastHashJoin" in txt
    # the only full-row exchanges are on the change side; the target is never hash-partitioned whole
    assert "SortMergeJoin" not in txt


def test_material_mart_one_scan_no_python(spark):
    out = material_demand(fx.demand(spark, SF_SMALL), unit="g")
    txt = plan_of(out)
    assert txt.count("FileScan parquet") == 2  # lineitem and part, each once
    assert "Expand" in txt  # the unpivot
    assert "Python" not in txt and "ArrowEval" not in txt
    assert "HashAggregate" in txt and "partial" in plan_of(out).lower()
