"""

Runs each query end to end (planning, the size probes it makes, execution into
a no-op sink) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints ONE
JSON line: {"metric", "value", "unit", "queries", "sf"}. Each query runs once
untimed (JVM class loading and code generation for its plan shapes) and is
then timed on its second run; ``$BENCH_RUNS`` > 2 reports the best timed run.

the first day of the data, run day by day through the library's ``replay``
(append, merge, checks, published snapshot per day). The whole-span replays
are ``replay_catchup`` (one pass) and, by name only, ``replay_state``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "latest_change_per_id",
    "merge_full",
    "merge_small_change",
    "merge_interval",
    "material_grams",
    "material_kg",
    "column_check_report",
    "replay_6d",
    "replay_catchup",
]


def replay_6d(spark, sf_dir):
    """Six consecutive days of the daily job, from the first day of the data."""
    import datetime as dt
    from cdcmart.plans import fixtures as fx
    from cdcmart.plans.jobs import data_span, replay
    from cdcmart.session import scratch_path
    from cdcmart.sources.snapshots import SnapshotStore
    origin, changes = fx.origin_e(spark, sf_dir), fx.stage_e(spark, sf_dir)
    start = data_span((origin, "invoicedate"), (changes, "invoicedate")).start
    store = SnapshotStore(spark, scratch_path(spark, "bench-replay"))
    return replay(store, origin, changes, start, start + dt.timedelta(days=6))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from cdcmart.plans.catalog import queries
    from cdcmart.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    q = dict(queries(), replay_6d=replay_6d)
    runs = max(2, int(os.environ.get("BENCH_RUNS", "2")))
    timings = {}
    for name in names:
        best = None
        for run in range(runs):
            t0 = time.perf_counter()
            q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - t0
            if run > 0:
                best = took if best is None else min(best, took)
        timings[name] = round(best, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
