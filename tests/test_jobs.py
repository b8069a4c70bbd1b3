"""Daily jobs and the replay, against a brute-force fold on a small fixture."""

import datetime as dt

import pytest
from conftest import retail, rows_of, ts

from cdcmart.functions.interval import Interval
from cdcmart.operators.keys import ConstraintViolation
from cdcmart.plans.jobs import data_span, replay, run_day, run_extract, run_material_g, run_material_kg, run_origin
from cdcmart.schemas import DEMAND_SCHEMA
from cdcmart.sources.snapshots import SnapshotStore


def origin_rows():
    rows = []
    for day in range(1, 5):
        for k in range(4):
            rid = day * 10 + k
            t = ts(f"2024-01-0{day} 0{k}:00")
            rows.append((rid, f"O{rid}", k, t, t, None))
    return rows


def change_rows():
    rows = []
    ops = "IUDXU"
    n = 0
    for day in range(1, 5):
        for k in range(6):
            # ids from this day, the day before, and new ids
            rid = [day * 10 + k % 4, (day - 1) * 10 + k % 4, 100 + day * 10 + k][k % 3]
            t = ts(f"2024-01-0{day} {10 + k}:00")
            rows.append((rid, f"C{n}", 100 + n, t, t, ops[n % 5]))
            n += 1
    return rows


def brute_force(origin, changes, days):
    """The merge written directly in Python, day by day."""
    state = []
    for d in days:
        lo, hi = dt.datetime.combine(d, dt.time()), dt.datetime.combine(d + dt.timedelta(days=1), dt.time())
        state += [list(r) for r in origin if lo <= r[5] < hi]
        latest = {}
        for r in changes:
            if lo <= r[5] < hi and (r[0] not in latest or r[9] > latest[r[0]][9]):
                latest[r[0]] = r
        ids = {r[0] for r in state}
        new_state = []
        for r in state:
            c = latest.get(r[0])
            if c is None or c[10] not in ("U", "D"):
                new_state.append(r)
            elif c[10] == "U":
                new_state.append([r[0]] + list(c[1:]))
        new_state += [list(c) for c in latest.values() if c[10] == "I" and c[0] not in ids]
        state = new_state
    return sorted((r[0], r[1], r[4], r[10]) for r in state)


def full_rows(spark, rows):
    return [tuple(r) for r in retail(spark, rows).collect()]


def test_replay_matches_brute_force(spark, tmp_path):
    origin, changes = retail(spark, origin_rows()), retail(spark, change_rows())
    store = SnapshotStore(spark, str(tmp_path / "snap"))
    span = data_span((origin, "invoicedate"), (changes, "invoicedate"))
    assert (span.start, span.end) == (dt.date(2024, 1, 1), dt.date(2024, 1, 5))
    final = replay(store, origin, changes, span.start, span.end)
    days = [d.start for d in span.days()]
    expect = brute_force(full_rows(spark, origin_rows()), full_rows(spark, change_rows()), days)
    assert rows_of(final, "id", "invoice", "quantity", "operation") == expect
    # rerunning a day from the previous snapshot gives the same state, published as newest
    first_path = store.path("2024-01-03")
    again = run_day(store, origin, changes, "2024-01-03")
    assert again != first_path and store.path("2024-01-03") == again
    assert rows_of(spark.read.parquet(again)) == rows_of(spark.read.parquet(first_path))


def test_failed_check_publishes_nothing(spark, tmp_path):
    origin = retail(spark, [(1, "o", 5, ts("2024-01-01 01:00"), ts("2024-01-01 01:00"), None)])
    changes = retail(spark, [(1, "c", -5000, ts("2024-01-01 02:00"), ts("2024-01-01 02:00"), "U")])
    store = SnapshotStore(spark, str(tmp_path / "snap"))
    with pytest.raises(ConstraintViolation):
        run_day(store, origin, changes, "2024-01-01")
    assert store.path("2024-01-01") is None


def test_append_repeating_key_raises(spark):
    t = ts("2024-01-01 01:00")
    state = retail(spark, [(1, "o", 5, t, t, None)])
    origin = retail(spark, [(1, "again", 5, t, t, None)])
    with pytest.raises(ConstraintViolation):
        run_origin(state, origin, Interval.day("2024-01-01"))


def test_demand_jobs(spark, tmp_path):
    root = str(tmp_path / "lake")
    d = ts("2024-01-01 00:00")
    demand = spark.createDataFrame([("S1", d, "cheap", "1"), ("S1", d, "medium", "2"), (None, d, "cheap", "3"),
                                    ("S2", ts("2024-01-02 00:00"), "cheap", "4")], DEMAND_SCHEMA)
    day = Interval.day("2024-01-01")
    run_extract(demand, root, day)
    kg = run_material_kg(spark, root, day)
    got = {(r["shop_id"], r["raw_material"]): float(r["demand_kg"]) for r in kg.collect()}
    assert got == {("S1", "local_arabica"): 0.04, ("S1", "foreign_arabica"): 0.02, ("S1", "robusta"): 0.0}
    target = spark.createDataFrame([], "date timestamp_ntz, shop_id string, material_name string, "
                                   "quantity_g decimal(38,4)")
    g = run_material_g(spark, demand, target, day)
    assert g.count() == 6  # S1 and the NULL shop, three materials each


def test_catch_up_equals_day_by_day(spark, tmp_path):
    from cdcmart.operators.catchup import catch_up
    origin, changes = retail(spark, origin_rows()), retail(spark, change_rows())
    days = [dt.date(2024, 1, d) for d in range(1, 5)]
    expect = brute_force(full_rows(spark, origin_rows()), full_rows(spark, change_rows()), days)
    one_pass = catch_up(origin, changes, "2024-01-01", "2024-01-05")
    assert rows_of(one_pass, "id", "invoice", "quantity", "operation") == expect
    # from a snapshot: days 1-2 replayed, then days 3-4 caught up from it
    store = SnapshotStore(spark, str(tmp_path / "snap"))
    mid = replay(store, origin, changes, "2024-01-01", "2024-01-03")
    rest = catch_up(origin, changes, "2024-01-03", "2024-01-05", initial=mid)
    assert rows_of(rest, "id", "invoice", "quantity", "operation") == expect


def test_catch_up_edge_histories(spark):
    from cdcmart.operators.catchup import catch_up
    d = lambda day, h: ts(f"2024-01-0{day} {h:02d}:00")
    origin = retail(spark, [(1, "o1", 1, d(1, 1), d(1, 1), None), (1, "o1b", 2, d(3, 1), d(3, 1), None),
                            (2, "o2", 1, d(1, 1), d(1, 1), None)])
    changes = retail(spark, [
        (1, "d1", 0, d(2, 5), d(2, 5), "D"),   # kills o1
        (1, "i1", 0, d(2, 6), d(2, 6), "I"),   # same day, later: the latest of day 2 is this I -> inserts?
        (2, "u2", 7, d(1, 5), d(1, 5), "U"),   # same day as the append: applies
        (2, "x2", 8, d(2, 5), d(2, 5), "X"),
        (3, "i3", 9, d(1, 5), d(1, 5), "I"),   # new id inserted
        (3, "u3", 10, d(2, 5), d(2, 5), "U"),  # then updated
        (3, "d3", 11, d(3, 5), d(3, 5), "D"),  # then deleted
        (3, "i3b", 12, d(4, 5), d(4, 5), "I"),  # and inserted again
    ])
    days = [dt.date(2024, 1, k) for k in range(1, 5)]
    expect = brute_force(full_rows(spark, [(1, "o1", 1, d(1, 1), d(1, 1), None),
                                           (1, "o1b", 2, d(3, 1), d(3, 1), None),
                                           (2, "o2", 1, d(1, 1), d(1, 1), None)]),
                         [tuple(r) for r in changes.collect()], days)
    got = rows_of(catch_up(origin, changes, "2024-01-01", "2024-01-05"), "id", "invoice", "quantity", "operation")
    assert got == expect


def test_catch_up_null_keys_match_day_by_day(spark, tmp_path):
    """A NULL id never matches: every day's latest NULL-id 'I' inserts, NULL-id
    'U'/'D' touch nothing, NULL-id rows are never updated or deleted."""
    from cdcmart.operators.catchup import catch_up
    d = lambda day, h: ts(f"2024-01-0{day} {h:02d}:00")
    origin = retail(spark, [(None, "oN", 1, d(1, 1), d(1, 1), None), (1, "o1", 1, d(1, 1), d(1, 2), None)])
    changes = retail(spark, [(None, "iN1", 2, d(1, 5), d(1, 5), "I"), (None, "iN2", 3, d(2, 5), d(2, 5), "I"),
                             (None, "uN", 4, d(3, 5), d(3, 5), "U"), (None, "dN", 5, d(3, 4), d(3, 4), "D"),
                             (1, "u1", 6, d(2, 5), d(2, 5), "U")])
    # The whole-span day-by-day replay; this fixture has no key collisions to check.
    store = SnapshotStore(spark, str(tmp_path / "snap"))
    seq = replay(store, origin, changes, "2024-01-01", "2024-01-04", checks=None, keys=None)
    one = catch_up(origin, changes, "2024-01-01", "2024-01-04")
    assert rows_of(one, "id", "invoice", "quantity") == rows_of(seq, "id", "invoice", "quantity")
    # day 3's latest NULL-id change is the 'U' (05:00 after the 'D' at 04:00): unmatched, ignored
    assert rows_of(one, "id", "invoice") == [(1, "u1"), (None, "iN1"), (None, "iN2"), (None, "oN")]


def test_replay_resumes_after_the_last_published_day(spark, tmp_path):
    origin, changes = retail(spark, origin_rows()), retail(spark, change_rows())
    store = SnapshotStore(spark, str(tmp_path / "snap"))
    replay(store, origin, changes, "2024-01-01", "2024-01-03")          # cut short after day 2
    first_day2 = store.path("2024-01-02")
    final = replay(store, origin, changes, "2024-01-01", "2024-01-05", resume=True)
    assert store.path("2024-01-02") == first_day2                       # days 1-2 not rerun
    days = [dt.date(2024, 1, d) for d in range(1, 5)]
    expect = brute_force(full_rows(spark, origin_rows()), full_rows(spark, change_rows()), days)
    assert rows_of(final, "id", "invoice", "quantity", "operation") == expect


def test_quiet_day_republishes_previous_snapshot(spark, tmp_path):
    origin, changes = retail(spark, origin_rows()), retail(spark, change_rows())
    store = SnapshotStore(spark, str(tmp_path / "snap"))
    final = replay(store, origin, changes, "2024-01-01", "2024-01-07")   # days 5 and 6 have no rows
    assert store.path("2024-01-05") == store.path("2024-01-04") == store.path("2024-01-06")
    days = [dt.date(2024, 1, d) for d in range(1, 5)]
    expect = brute_force(full_rows(spark, origin_rows()), full_rows(spark, change_rows()), days)
    assert rows_of(final, "id", "invoice", "quantity", "operation") == expect
