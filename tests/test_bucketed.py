"""The merge on a table that Spark keeps bucketed: results, plans, hot buckets."""

import datetime as dt
import re
import uuid

import pytest
from conftest import plan_of, retail, rows_of, ts

from cdcmart.operators.keys import ConstraintViolation
from cdcmart.operators.merge import apply_changes
from cdcmart.plans.jobs import replay_bucketed, run_day_bucketed
from cdcmart.sources.bucketed import bucket_spec, bucketed_target, create_bucketed, merge_bucketed, merged_frame

T0, T1 = ts("2024-01-01 08:00"), ts("2024-01-02 08:00")


def name(prefix="t"):
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def target_rows(spark):
    return retail(spark, [(i, f"T{i}", i, T0, T0, None) for i in range(40)] + [(7, "dup", 1, T0, T1, None), (None, "none", 1, T0, T0, None)])


def change_rows(spark):
    return retail(spark, [(3, "u3", 0, T1, T1, "U"), (7, "d7", 0, T1, T1, "D"), (100, "i100", 0, T1, T1, "I"),
                          (5, "i5", 0, T1, T1, "I"), (200, "u200", 0, T1, T1, "U"), (None, "n", 0, T1, T1, "U")])


def test_merge_equals_apply_changes(spark):
    table, result = name(), name()
    create_bucketed(target_rows(spark), table, "id", buckets=8)
    before = rows_of(spark.table(table))
    got = merge_bucketed(spark, table, change_rows(spark), result)
    assert rows_of(got) == rows_of(apply_changes(target_rows(spark), change_rows(spark)))
    assert bucket_spec(spark, result) == bucket_spec(spark, table) == (["id"], 8)
    assert rows_of(spark.table(table)) == before


def test_the_target_has_no_exchange(spark):
    table = name()
    create_bucketed(target_rows(spark), table, "id", buckets=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = merged_frame(spark, table, change_rows(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = 0
    lines = tree.split("\n")
    for i, line in enumerate(lines):
        if "Bucketed: true" in line:
            scans += 1
            depth = len(re.match(r"[\s:|+*-]*", line).group())
            for above in reversed(lines[:i]):
                own = len(re.match(r"[\s:|+*-]*", above).group())
                if own < depth:
                    depth = own
                    assert "Exchange" not in above, tree
    assert scans == 2 and "Exchange hashpartitioning" in tree


def test_a_hot_bucket_is_read_in_splits(spark):
    table, result = name(), name()
    hot = retail(spark, [(1, f"h{i}", i, T0, T0, None) for i in range(60)] + [(i, f"T{i}", i, T0, T0, None) for i in range(2, 40)])
    create_bucketed(hot, table, "id", buckets=16)
    assert "Bucketed: true" not in plan_of(bucketed_target(spark, table).groupBy("id").count())
    got = merge_bucketed(spark, table, change_rows(spark), result)
    assert rows_of(got) == rows_of(apply_changes(hot, change_rows(spark)))


def test_empty_table_and_plain_table(spark):
    table, plain = name(), name()
    create_bucketed(target_rows(spark).where("false"), table, "id", buckets=4)
    got = merge_bucketed(spark, table, change_rows(spark), name())
    assert rows_of(got, "id") == [(5,), (100,)]
    target_rows(spark).write.saveAsTable(plain)
    with pytest.raises(ValueError, match="not a bucketed table"):
        bucket_spec(spark, plain)


def test_replay_matches_brute_force(spark):
    from test_jobs import brute_force, change_rows, full_rows, origin_rows
    origin, changes = retail(spark, origin_rows()), retail(spark, change_rows())
    got = replay_bucketed(spark, name(), origin, changes, "2024-01-01", "2024-01-05", buckets=4)
    days = [dt.date(2024, 1, d) for d in range(1, 5)]
    assert rows_of(got, "id", "invoice", "quantity", "operation") == brute_force(
        full_rows(spark, origin_rows()), full_rows(spark, change_rows()), days)


def test_failing_checks_change_nothing(spark):
    table, result = name(), name()
    create_bucketed(retail(spark, [(1, "a", 5, T0, T0, None)]), table, "id", buckets=4)
    bad = retail(spark, [(1, "u", -5000, T1, T1, "U")])
    with pytest.raises(ConstraintViolation):
        run_day_bucketed(spark, table, result, bad.where("false"), bad, "2024-01-02")
    assert rows_of(spark.table(table), "invoice") == [("a",)] and not spark.catalog.tableExists(result)
