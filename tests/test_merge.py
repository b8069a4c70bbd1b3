"""Merge semantics: the outcome table, multiplicity, strategies, slices, upsert."""

import pytest
from conftest import plan_of, retail, rows_of, srt, ts

from cdcmart.functions.interval import Interval
from cdcmart.operators.keys import ConstraintViolation
from cdcmart.operators.latest import latest_per_key
from cdcmart.operators.merge import (append_interval, apply_changes, cdc_interval, classify_changes,
                                     merge_outcomes, upsert)
from cdcmart.schemas import RETAIL_COLUMNS_NO_OP

D1, D2 = ts("2024-01-01 08:00"), ts("2024-01-01 09:00")


def target_10(spark):
    # ids 1..5 exist in the target
    return retail(spark, [(i, f"T{i}", i, D1, D1, None) for i in range(1, 6)])


def changes_10(spark):
    # matched ids 1-5 with I, U, D, X, NULL; unmatched ids 11-15 with the same ops
    ops = ["I", "U", "D", "X", None]
    rows = [(i + 1, f"C{i + 1}", 100 + i, D2, D2, op) for i, op in enumerate(ops)]
    rows += [(i + 11, f"C{i + 11}", 200 + i, D2, D2, op) for i, op in enumerate(ops)]
    return retail(spark, rows)


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast", "auto"])
def test_outcome_table(spark, strategy):
    out = apply_changes(target_10(spark), changes_10(spark), strategy=strategy)
    got = {r["id"]: (r["invoice"], r["operation"]) for r in out.collect()}
    assert got == {
        1: ("T1", None),      # matched I: keep target
        2: ("C2", "U"),       # matched U: overwrite (operation too)
        # 3: matched D: deleted
        4: ("T4", None),      # matched X: keep
        5: ("T5", None),      # matched NULL op: keep
        11: ("C11", "I"),     # unmatched I: insert
        # 12-15: unmatched U, D, X, NULL: ignored
    }
    assert out.columns == target_10(spark).columns


def test_update_overwrites_every_non_key_column(spark):
    out = apply_changes(target_10(spark), changes_10(spark), strategy="shuffle")
    r = out.where("id = 2").first()
    assert (r["invoice"], r["quantity"], r["invoicedate"], r["last_updated"], r["operation"]) == \
        ("C2", 101, D2, D2, "U")


def test_duplicate_target_ids_keep_multiplicity(spark):
    target = retail(spark, [(1, "A", 1, D1, D1, None), (1, "B", 2, D1, D2, None),
                            (2, "C", 3, D1, D1, None), (2, "D", 4, D1, D2, None),
                            (3, "E", 5, D1, D1, None)])
    changes = retail(spark, [(1, "U1", 9, D2, D2, "U"), (2, "X", 9, D2, D2, "D"), (3, "I", 9, D2, D2, "I")])
    for strategy in ("shuffle", "broadcast"):
        out = apply_changes(target, changes, strategy=strategy)
        assert rows_of(out, "id", "invoice") == [(1, "U1"), (1, "U1"), (3, "E")]


def test_empty_change_set_is_identity(spark):
    t = target_10(spark)
    empty = changes_10(spark).where("false")
    assert rows_of(apply_changes(t, empty)) == rows_of(t)


def test_empty_target_inserts_only_I(spark):
    t = target_10(spark).where("false")
    out = apply_changes(t, changes_10(spark))
    assert rows_of(out, "id", "operation") == [(1, "I"), (11, "I")]


def test_applying_same_slice_twice_is_once_for_U_and_D(spark):
    t = target_10(spark)
    c = changes_10(spark).where("operation in ('U', 'D')")
    once = apply_changes(t, c)
    twice = apply_changes(once, c)
    assert rows_of(once) == rows_of(twice)


def test_null_id_never_matches(spark):
    t = retail(spark, [(None, "T", 1, D1, D1, None), (1, "T1", 1, D1, D1, None)])
    c = retail(spark, [(None, "C", 2, D2, D2, "D"), (None, "N", 3, D2, D2, "I")])
    out = apply_changes(t, c)
    # the NULL-id delete matches nothing; the NULL-id insert is unmatched, so inserted
    assert rows_of(out, "id", "invoice") == srt([(None, "T"), (1, "T1"), (None, "N")])


def test_ten_column_target_does_not_store_operation(spark):
    t = target_10(spark).select(*RETAIL_COLUMNS_NO_OP)
    out = apply_changes(t, changes_10(spark))
    assert out.columns == list(RETAIL_COLUMNS_NO_OP)
    assert rows_of(out, "id", "invoice") == [(1, "T1"), (2, "C2"), (4, "T4"), (5, "T5"), (11, "C11")]


def test_unmatched_update_lost_by_default_and_optional_upsert(spark):
    t = target_10(spark)
    # I then U for a new id inside one slice: latest is U, unmatched -> lost
    c = retail(spark, [(50, "new", 1, D1, D1, "I"), (50, "upd", 2, D2, D2, "U")])
    latest = latest_per_key(c)
    assert 50 not in [r["id"] for r in apply_changes(t, latest).collect()]
    kept = apply_changes(t, latest, upsert_unmatched_updates=True)
    assert rows_of(kept.where("id = 50"), "invoice") == [("upd",)]


def test_update_then_delete_in_one_slice_deletes(spark):
    t = target_10(spark)
    c = retail(spark, [(2, "u", 1, D1, D1, "U"), (2, "d", 1, D1, D2, "D")])
    out = cdc_interval(t, c)
    assert 2 not in [r["id"] for r in out.collect()]


def test_filter_precedes_window(spark):
    t = target_10(spark)
    day1, day2 = ts("2024-01-01 10:00"), ts("2024-01-02 10:00")
    # latest overall is a D on day 2, but inside day 1 the latest is a U
    c = retail(spark, [(1, "u", 1, day1, day1, "U"), (1, "d", 1, day2, day2, "D")])
    out = cdc_interval(t, c, Interval.day("2024-01-01"))
    assert rows_of(out.where("id = 1"), "invoice") == [("u",)]


def test_broadcast_and_shuffle_plans_agree_on_fixture(spark):
    from conftest import SF_SMALL
    from cdcmart.plans import fixtures as fx
    target, latest = fx.origin_o(spark, SF_SMALL), latest_per_key(fx.stage_o(spark, SF_SMALL))
    a = apply_changes(target, latest, strategy="shuffle")
    b = apply_changes(target, latest, strategy="broadcast")
    assert rows_of(a) == rows_of(b)
    # |out| = |t| - D_matched + I_unmatched (unique target ids)
    cls = classify_changes(target, latest)
    n_del = cls.where("outcome = 'delete'").count()
    n_ins = cls.where("outcome = 'insert'").count()
    assert a.count() == target.count() - n_del + n_ins


def test_classify_and_outcome_counts(spark):
    cls = classify_changes(target_10(spark), changes_10(spark))
    got = {r["id"]: r["outcome"] for r in cls.collect()}
    assert got == {1: "matched_noop", 2: "update", 3: "delete", 4: "matched_noop", 5: "matched_noop",
                   11: "insert", 12: "unmatched_ignored", 13: "unmatched_ignored",
                   14: "unmatched_ignored", 15: "unmatched_ignored"}
    counts = {r["outcome"]: r["n"] for r in merge_outcomes(target_10(spark), changes_10(spark)).collect()}
    assert counts == {"matched_noop": 3, "update": 1, "delete": 1, "insert": 1,
                      "unmatched_ignored": 4, "untouched": 0}


def test_append_interval_edges(spark):
    target = target_10(spark).where("false")
    src = retail(spark, [(1, "start", 1, ts("2009-12-01 00:00"), D1, None),
                         (2, "end", 1, ts("2009-12-02 00:00"), D1, None),
                         (3, "before", 1, ts("2009-11-30 23:59:59"), D1, None)])
    for iv in (Interval.parse("2009-12-01", "2009-12-02"), Interval.parse("20091201", "20091202")):
        assert rows_of(append_interval(target, src, iv), "invoice") == [("start",)]


def test_upsert_new_existing_and_duplicate_keys(spark):
    schema = "date string, shop_id string, material_name string, quantity_g double"
    target = spark.createDataFrame([("d1", "s1", "robusta", 1.0), ("d1", "s2", "robusta", 2.0),
                                    ("d1", None, "robusta", 3.0)], schema)
    source = spark.createDataFrame([("d1", "s1", "robusta", 10.0), ("d2", "s1", "robusta", 20.0),
                                    ("d1", None, "robusta", 30.0)], schema)
    out = upsert(target, source)
    assert rows_of(out) == srt([("d1", "s1", "robusta", 10.0), ("d1", "s2", "robusta", 2.0),
                                ("d2", "s1", "robusta", 20.0), ("d1", None, "robusta", 3.0),
                                ("d1", None, "robusta", 30.0)])
    dup = spark.createDataFrame([("d1", "s1", "robusta", 1.0), ("d1", "s1", "robusta", 2.0)], schema)
    with pytest.raises(ConstraintViolation):
        upsert(target, dup)


def test_merge_into_file_table_is_rejected(spark):
    from pyspark.errors import PySparkException
    from cdcmart.operators.merge import merge_into_table
    from cdcmart.sources.tables import ensure_table
    from cdcmart.schemas import RETAIL_SCHEMA
    ensure_table(spark, "wh_test.merge_target", RETAIL_SCHEMA, replace=True)
    with pytest.raises(PySparkException) as err:
        merge_into_table(changes_10(spark), "wh_test.merge_target")
    assert "does not support MERGE" in str(err.value)
    spark.sql("DROP TABLE wh_test.merge_target")


def test_target_keys_are_neither_sorted_nor_held_whole(spark):
    target = retail(spark, [(i % 300, f"T{i}", i, ts("2024-01-01"), ts("2024-01-01"), None) for i in range(900)])
    changes = retail(spark, [(i, f"C{i}", 1, ts("2024-01-01"), ts("2024-01-01"), "I") for i in range(200, 400)] + [(None, "N", 1, ts("2024-01-01"), ts("2024-01-01"), "I")])
    out = apply_changes(target, changes, strategy="shuffle", broadcast_limit_bytes=0)
    plan = plan_of(out)
    probe = plan[plan.index("ShuffledHashJoin"):]  # below the step that makes the matching keys distinct
    assert "Inner, BuildRight" in probe and "HashAggregate" not in probe and "ShuffledHashJoin" in plan
    got = rows_of(out.where("invoice LIKE 'C%' OR invoice = 'N'"), "id")
    assert got == [(i,) for i in range(300, 400)] + [(None,)] and out.count() == 1001


def test_a_mart_is_not_sorted_for_an_upsert(spark):
    schema = "date timestamp_ntz, shop_id string, material_name string, quantity_g int"
    mart = spark.createDataFrame([(ts("2024-01-01"), f"S{i}", "robusta", i) for i in range(50)] + [(ts("2024-01-01"), None, "robusta", 7)], schema)
    batch = spark.createDataFrame([(ts("2024-01-01"), f"S{i}", "robusta", -1) for i in range(40, 60)] + [(ts("2024-01-01"), None, "robusta", -1)], schema)
    out = upsert(mart, batch, broadcast_limit_bytes=0)
    plan = plan_of(out)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows_of(out.where("quantity_g >= 0"), "quantity_g") == sorted([(i,) for i in range(40)] + [(7,)])
    assert out.count() == 41 + 21
    assert upsert(mart, batch.limit(0)).count() == 51
