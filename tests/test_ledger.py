"""The ledger of published days, late and split days of the stream, constraints."""

import itertools

import pytest
from conftest import retail, rows_of, ts
from test_jobs import change_rows, origin_rows

from cdcmart.operators.catchup import catch_up
from cdcmart.operators.keys import ConstraintViolation
from cdcmart.plans.jobs import refresh, replay, rerun, run_day
from cdcmart.sources.snapshots import SnapshotStore
from cdcmart.streaming.changes import merge_batch, merge_stream


def inputs(spark):
    return retail(spark, origin_rows()), retail(spark, change_rows())


def test_a_gap_is_refused(spark, tmp_path):
    origin, changes = inputs(spark)
    store = SnapshotStore(spark, str(tmp_path / "snap"))
    run_day(store, origin, changes, "2024-01-01")
    with pytest.raises(ConstraintViolation, match="2024-01-02 is not published"):
        run_day(store, origin, changes, "2024-01-03")
    assert list(store.chain()) == ["2024-01-01"]
    run_day(store, origin, changes, "2024-01-02")
    run_day(store, origin, changes, "2024-01-03")
    assert rows_of(spark.read.parquet(store.path("2024-01-03"))) == rows_of(catch_up(origin, changes, "2024-01-01", "2024-01-04"))


def test_refresh_runs_only_what_changed(spark, tmp_path):
    origin, changes = inputs(spark)
    store = SnapshotStore(spark, str(tmp_path / "snap"))
    days = [f"2024-01-0{d}" for d in range(1, 5)]
    assert refresh(store, origin, changes, "2024-01-01", "2024-01-05")[1] == days
    assert refresh(store, origin.repartition(3), changes.orderBy("invoice"), "2024-01-01", "2024-01-05")[1] == []
    more = changes.unionByName(retail(spark, [(20, "late", 7, ts("2024-01-03 23:00"), ts("2024-01-03 23:00"), "U")]))
    state, ran = refresh(store, origin, more, "2024-01-01", "2024-01-05")
    assert ran == days[2:]
    assert rows_of(state) == rows_of(catch_up(origin, more, "2024-01-01", "2024-01-05"))
    chain = store.chain()
    assert [chain[b]["parent"] for b in days[1:]] == [chain[a]["run"] for a in days[:-1]]
    # a day run again retracts the days built on it, until they are run again
    run_day(store, origin, changes, "2024-01-02")
    assert list(store.chain()) == days[:2] and store.path("2024-01-03") is None
    assert refresh(store, origin, changes, "2024-01-01", "2024-01-05")[1] == days[2:]


def test_rerun_and_replay_keep_the_chain(spark, tmp_path):
    origin, changes = inputs(spark)
    store = SnapshotStore(spark, str(tmp_path / "snap"))
    replay(store, origin, changes, "2024-01-01", "2024-01-05")
    rerun(store, origin, changes, "2024-01-03")
    assert len(store.chain()) == 4
    assert refresh(store, origin, changes, "2024-01-01", "2024-01-05")[1] == []


PROBE = [(9, "new", 1, ts("2024-01-01 10:00"), ts("2024-01-01 10:00"), "I"),
         (9, "upd", 2, ts("2024-01-01 11:00"), ts("2024-01-01 11:00"), "U"),
         (1, "two", 3, ts("2024-01-02 09:00"), ts("2024-01-02 09:00"), "U"),
         (9, "third", 4, ts("2024-01-03 08:00"), ts("2024-01-03 08:00"), "I")]


def test_state_does_not_depend_on_files_or_order(spark, tmp_path):
    start = retail(spark, [(1, "o", 5, ts("2023-12-31 01:00"), ts("2023-12-31 01:00"), None)])
    want = rows_of(catch_up(start.where("false"), retail(spark, PROBE), "2024-01-01", "2024-01-04", initial=start))
    cuts = [[PROBE], [[r] for r in PROBE], [[r] for r in reversed(PROBE)], [PROBE[1::2], PROBE[::2]]]
    for n, (parts, files) in enumerate(itertools.product(cuts, (1, None))):
        store = SnapshotStore(spark, str(tmp_path / f"state{n}"))
        store.write(start, "2023-12-31")
        src = str(tmp_path / f"changes{n}")
        for part in parts:
            retail(spark, part).coalesce(1).write.mode("append").parquet(src)
        merge_stream(spark, src, store, files_per_batch=files)
        assert rows_of(spark.read.parquet(store.newest()[1])) == want, (n, files)
        assert store.newest()[0] == "2024-01-03"


def test_a_batch_again_changes_nothing_and_old_days_are_refused(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "state"))
    store.write(retail(spark, [(1, "o", 5, ts("2023-12-31 01:00"), ts("2023-12-31 01:00"), None)]), "2023-12-31")
    batch = retail(spark, PROBE)
    first = rows_of(spark.read.parquet(merge_batch(store, batch, batch_id=0)))
    assert rows_of(spark.read.parquet(merge_batch(store, batch, batch_id=0))) == first
    assert merge_batch(store, batch.where("false"), batch_id=1) is None
    with pytest.raises(ConstraintViolation, match="older than the first snapshot"):
        merge_batch(store, retail(spark, [(1, "x", 1, ts("2023-12-30 01:00"), ts("2023-12-30 01:00"), "U")]), batch_id=2)


@pytest.mark.parametrize("row, message", [
    ((None, "n", 1, ts("2024-01-01 12:00"), ts("2024-01-01 12:00"), "I"), "1 rows without id"),
    ((99, "n", 1, ts("2024-01-01 12:00"), None, "I"), "1 rows without last_updated"),
    ((99, "x" * 150, 1, ts("2024-01-01 12:00"), ts("2024-01-01 12:00"), "I"), "1 texts of invoice over 100")])
def test_constraints_of_merged_rows(spark, tmp_path, row, message):
    store = SnapshotStore(spark, str(tmp_path / "snap"))
    changes = retail(spark, [row])
    with pytest.raises(ConstraintViolation, match=message):
        run_day(store, changes.where("false"), changes, "2024-01-01")
    with pytest.raises(ConstraintViolation, match=message):
        merge_batch(store, changes, batch_id=0)
    assert store.newest() is None
