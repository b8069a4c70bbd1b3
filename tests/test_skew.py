"""One key holding a third of all rows: results stay whole and exact."""

import datetime as dt

from conftest import retail, rows_of, ts

from cdcmart.operators.catchup import catch_up
from cdcmart.operators.latest import latest_per_key
from cdcmart.operators.merge import apply_changes
from test_jobs import brute_force

T0 = ts("2024-01-01 08:00")


def skewed_target(spark, n=300):
    # id 0 holds a third of the rows (distinct last_updated keeps (id, last_updated) a key)
    rows = [(0 if i % 3 == 0 else i, f"T{i}", i, T0, T0 + dt.timedelta(seconds=i), None) for i in range(n)]
    return retail(spark, rows)


def test_hot_target_key_update_and_delete(spark):
    target = skewed_target(spark)
    for op, expect_hot in (("U", 100), ("D", 0)):
        changes = retail(spark, [(0, "hot", -1, T0, T0 + dt.timedelta(hours=1), op),
                                 (1, "one", -1, T0, T0 + dt.timedelta(hours=1), "U")])
        for strategy in ("shuffle", "broadcast"):
            out = apply_changes(target, changes, strategy=strategy)
            assert out.count() == 200 + expect_hot
            hot = out.where("id = 0")
            assert hot.count() == expect_hot
            if op == "U":
                assert rows_of(hot.select("invoice").distinct()) == [("hot",)]


def test_hot_change_key_reduced_to_one(spark):
    t = T0
    feed = retail(spark, [(7, f"C{i}", i, t, t + dt.timedelta(seconds=i), "U") for i in range(500)]
                  + [(8, "x", 0, t, t, "D")])
    latest = latest_per_key(feed)
    assert rows_of(latest, "id", "invoice") == [(7, "C499"), (8, "x")]


def test_hot_key_catch_up(spark):
    origin_rows = [(0 if i % 3 == 0 else i, f"O{i}", i, ts(f"2024-01-0{1 + i % 3} 01:00"),
                    ts(f"2024-01-0{1 + i % 3} 01:00") + dt.timedelta(seconds=i), None) for i in range(60)]
    change_rows = [(0, f"C{i}", 1000 + i, ts(f"2024-01-0{1 + i % 3} 05:00"),
                    ts(f"2024-01-0{1 + i % 3} 05:00") + dt.timedelta(seconds=i), "UUDIU"[i % 5]) for i in range(40)]
    origin, feed = retail(spark, origin_rows), retail(spark, change_rows)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    expect = brute_force([tuple(r) for r in origin.collect()], [tuple(r) for r in feed.collect()], days)
    got = catch_up(origin, feed, "2024-01-01", "2024-01-04")
    assert rows_of(got, "id", "invoice", "quantity", "operation") == expect
