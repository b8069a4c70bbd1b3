"""The streaming merge equals merging the same slices one after another."""

from conftest import retail, rows_of, ts

from cdcmart.operators.catchup import catch_up
from cdcmart.sources.snapshots import SnapshotStore
from cdcmart.streaming.changes import merge_stream


def test_stream_of_daily_files_equals_day_by_day(spark, tmp_path):
    initial = retail(spark, [(i, f"O{i}", i, ts("2023-12-31 10:00"), ts("2023-12-31 10:00"), None) for i in range(6)])
    rows = []
    ops = "UDIXU"
    for day in range(1, 4):
        for k in range(5):
            t = ts(f"2024-01-0{day} {10 + k}:00")
            rows.append(((day + k) % 8, f"C{day}{k}", 10 * day + k, t, t, ops[(day + k) % 5]))
    changes = retail(spark, rows)
    store = SnapshotStore(spark, str(tmp_path / "state"))
    store.write(initial, "2023-12-31")
    src = str(tmp_path / "changes")
    for day in range(1, 4):  # one file per day, landing in order
        changes.where(f"day(invoicedate) = {day}").coalesce(1).write.mode("append").parquet(src)
    merge_stream(spark, src, store, files_per_batch=1)
    got = spark.read.parquet(store.newest()[1])
    empty_origin = initial.where("false")
    expect = catch_up(empty_origin, changes, "2024-01-01", "2024-01-04", initial=initial)
    assert rows_of(got) == rows_of(expect)
    assert store.newest()[0] == "2024-01-03"


def test_stream_restart_processes_only_new_files(spark, tmp_path):
    initial = retail(spark, [(i, f"O{i}", i, ts("2023-12-31 10:00"), ts("2023-12-31 10:00"), None) for i in range(4)])
    rows = [(d % 4, f"C{d}", d, ts(f"2024-01-0{d} 10:00"), ts(f"2024-01-0{d} 10:00"), "U") for d in (1, 2, 3)]
    changes = retail(spark, rows)
    store = SnapshotStore(spark, str(tmp_path / "state"))
    store.write(initial, "2023-12-31")
    src = str(tmp_path / "changes")
    for day in (1, 2):
        changes.where(f"day(invoicedate) = {day}").coalesce(1).write.mode("append").parquet(src)
    merge_stream(spark, src, store, files_per_batch=1)
    published = spark.read.json(store.published_path).count()
    changes.where("day(invoicedate) = 3").coalesce(1).write.mode("append").parquet(src)
    merge_stream(spark, src, store, files_per_batch=1)          # same checkpoint: only the new file
    assert spark.read.json(store.published_path).count() == published + 1
    expect = catch_up(initial.where("false"), changes, "2024-01-01", "2024-01-04", initial=initial)
    assert rows_of(spark.read.parquet(store.newest()[1])) == rows_of(expect)


def test_batch_size_does_not_matter(spark, tmp_path):
    rows = [(9, "new", 1, ts("2024-01-01 10:00"), ts("2024-01-01 10:00"), "I"),
            (9, "upd", 2, ts("2024-01-02 10:00"), ts("2024-01-02 10:00"), "U")]
    src = str(tmp_path / "changes")
    for row in rows:
        retail(spark, [row]).coalesce(1).write.mode("append").parquet(src)
    states = []
    for n, files in enumerate((1, None)):
        store = SnapshotStore(spark, str(tmp_path / f"state{n}"))
        merge_stream(spark, src, store, files_per_batch=files)
        states.append(rows_of(spark.read.parquet(store.newest()[1]), "id", "invoice"))
    assert states == [[(9, "upd")], [(9, "upd")]]
