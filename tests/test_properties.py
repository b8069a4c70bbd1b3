"""Randomised histories: one-pass catch-up, both merge plans and a brute-force
fold must agree."""

import datetime as dt

from conftest import retail, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cdcmart.operators.catchup import catch_up
from cdcmart.operators.latest import latest_per_key
from cdcmart.operators.merge import apply_changes
from test_jobs import brute_force

DAYS = 4
OPS = ["I", "U", "D", "X", None]


def stamp(day, minute):
    return dt.datetime(2024, 1, day, 8, 0) + dt.timedelta(minutes=minute)


origin_row = st.tuples(st.integers(0, 5), st.integers(1, DAYS), st.integers(0, 50))
change_row = st.tuples(st.integers(0, 7), st.integers(1, DAYS), st.integers(0, 50), st.sampled_from(OPS))


def build(spark, origins, changes):
    o_rows, c_rows = [], []
    for n, (rid, day, minute) in enumerate(origins):
        t = stamp(day, minute)
        o_rows.append((rid, f"O{n}", n, t, t + dt.timedelta(seconds=n), None))
    for n, (rid, day, minute, op) in enumerate(changes):
        t = stamp(day, minute)
        # unique last_updated per row: the key (id, last_updated) holds
        c_rows.append((rid, f"C{n}", 100 + n, t, t + dt.timedelta(microseconds=n), op))
    return o_rows, c_rows


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(origin_row, max_size=10), st.lists(change_row, max_size=16))
def test_catch_up_matches_fold(spark, origins, changes):
    o_rows, c_rows = build(spark, origins, changes)
    origin, feed = retail(spark, o_rows), retail(spark, c_rows)
    days = [dt.date(2024, 1, d) for d in range(1, DAYS + 1)]
    expect = brute_force([tuple(r) for r in origin.collect()], [tuple(r) for r in feed.collect()], days)
    got = catch_up(origin, feed, "2024-01-01", f"2024-01-0{DAYS + 1}")
    assert rows_of(got, "id", "invoice", "quantity", "operation") == expect


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(origin_row, max_size=10), st.lists(change_row, max_size=16))
def test_merge_plans_agree(spark, origins, changes):
    o_rows, c_rows = build(spark, origins, changes)
    target, latest = retail(spark, o_rows), latest_per_key(retail(spark, c_rows))
    a = apply_changes(target, latest, strategy="shuffle", materialize=False)
    b = apply_changes(target, latest, strategy="broadcast")
    assert rows_of(a) == rows_of(b)
