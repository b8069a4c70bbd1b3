"""Daily jobs and the replay of consecutive days.

State is a snapshot per day: ``state(ds) = merge(append(state(ds-1), origin(ds)), changes(ds))``.
Days run in order (append D, merge D, then D+1). Each day is a few Spark
jobs that end in a snapshot written to the shared folder, which also cuts the
lineage: day D+1 reads day D's files, not day D's plan. A rerun of a day
writes a new snapshot of that day from the previous day's published one.

The driver only loops over days and reads back one-row answers (sizes, check
results, the manifest); no data rows pass through it.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.interval import DateLike, Interval, in_interval
from ..operators.checks import ObservedChecks, column_checks
from ..operators.deltas import mart_rows, signed_sums
from ..operators.keys import ConstraintViolation, ObservedConstraints
from ..operators.latest import latest_per_key
from ..operators.materials import material_demand
from ..operators.merge import append_interval, apply_changes, upsert
from ..operators.sizing import broadcast_limit, fits_broadcast, row_bytes
from ..schemas import (DEMAND_SCHEMA, MATERIAL_G_SCHEMA, MATERIAL_KG_SCHEMA, OP_DELETE, OP_UPDATE, RETAIL_CHECKS, RETAIL_LENGTHS,
                       RETAIL_SCHEMA)
from ..sources.lake import read_interval, write_interval
from ..sources.mart_state import load_delta, read_state
from ..sources.snapshots import SnapshotStore
from ..sources.tables import append, clear, ensure_table, read_table, replace_days


def new_key_collisions(state: DataFrame, new_rows: DataFrame, keys: Sequence[str],
                       broadcast: bool | None = None) -> DataFrame:
    """Keys of ``new_rows`` that already exist in ``state``, repeat inside
    ``new_rows`` or have a NULL part (the insert would violate the key). Only the new day's keys
    are checked; the state is read for its key columns. The new keys are
    broadcast only when their measured size fits (``broadcast=None`` measures)."""
    keys = list(keys)
    new_keys = new_rows.select(*keys)
    if broadcast is None:
        broadcast = fits_broadcast(new_keys)
    probe = F.broadcast(new_keys) if broadcast else new_keys
    existing = state.select(*keys).join(probe, keys, "left_semi")
    has_null = functools.reduce(operator.or_, (F.col(k).isNull() for k in keys))
    repeated = new_keys.groupBy(*keys).count().where((F.col("count") > 1) | has_null).select(*keys)
    return existing.unionByName(repeated)


def run_origin(state: DataFrame, origin: DataFrame, interval: Interval, column: str = "invoicedate",
               keys: Sequence[str] | None = ("id", "last_updated"),
               broadcast: bool | None = None) -> DataFrame:
    """Append the interval's origin rows to the state (B1). With ``keys``, a
    new row whose key already exists or is NULL raises, as the table's key
    would, and so does a text longer than its column."""
    appended = append_interval(state, origin, interval, column)
    if keys:
        new_rows = in_interval(origin, interval, column)
        too_long = functools.reduce(operator.or_, (F.length(c) > n for c, n in RETAIL_LENGTHS.items()
                                                   if c in new_rows.columns), F.lit(False))
        bad = (new_key_collisions(state, new_rows, keys, broadcast)
               .unionByName(new_rows.where(too_long).select(*keys)).limit(5).collect())
        if bad:
            raise ConstraintViolation(f"append of {interval.ds} repeats or lacks its key {tuple(keys)}, or has a "
                                      "text too long: " + ", ".join(str(tuple(r)) for r in bad))
    return appended


def empty_state(spark: SparkSession, schema=RETAIL_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")


def _digest(origin: tuple, changes: tuple) -> str:
    """Of a day's two slices, whatever the order of their rows: (rows, sum of row hashes) each."""
    return ";".join(f"{int(n)}:{int(h or 0)}" for n, h in (origin, changes))


def _measure_day(origin_day: DataFrame, changes_day: DataFrame, keys: Sequence[str]) -> tuple[int, int, int, int, str]:
    """Rows and key bytes of the new rows, rows of the changes and bytes of
    those that update or delete, and the digest of both: one pass, one job."""
    touches = F.col("operation").isin(OP_UPDATE, OP_DELETE)
    slices = [origin_day.select(F.lit(0).alias("tag"), row_bytes(origin_day.select(*keys)).alias("b"), _row_hash(origin_day).alias("h")),
              changes_day.select(F.lit(1).alias("tag"), F.when(touches, row_bytes(changes_day)).otherwise(0).alias("b"),
                                 _row_hash(changes_day).alias("h"))]
    observation = Observation("cdcmart_day")
    both = slices[0].unionByName(slices[1]).observe(observation, *[
        f.alias(f"{name}{i}") for i in (0, 1) for name, f in (
            ("n", F.count(F.when(F.col("tag") == i, 1))), ("b", F.sum(F.when(F.col("tag") == i, F.col("b")))),
            ("h", F.sum(F.when(F.col("tag") == i, F.col("h")))))])
    both.write.format("noop").mode("overwrite").save()
    got = observation.get
    return (int(got["n0"]), int(got["b0"] or 0), int(got["n1"]), int(got["b1"] or 0),
            _digest((got["n0"], got["h0"]), (got["n1"], got["h1"])))


def run_day(store: SnapshotStore, origin: DataFrame, changes: DataFrame, ds: DateLike,
            column: str = "invoicedate", checks: Mapping | None = RETAIL_CHECKS,
            keys: Sequence[str] | None = ("id", "last_updated"), strategy: str = "auto",
            schema=RETAIL_SCHEMA, previous: str | None = None) -> str:
    """One day: previous snapshot -> append -> merge -> write (+checks) -> publish.

    The checks and the table's constraints (keys not null, text lengths) are
    observed metrics of the snapshot write itself (no extra pass); the snapshot
    is published only when all hold, otherwise nothing is published and
    ``ConstraintViolation`` is raised.
    ``previous`` is the previous day's snapshot folder when the caller knows
    it (the replay does); otherwise the day before must be published: a day
    whose predecessor is missing is refused, unless it is the store's first.
    A quiet day (no origin rows, no changes) publishes the previous folder
    again instead of copying the state. The record names the record of the day
    before and the digest of the day's input.
    """
    spark = store.spark
    interval = Interval.day(ds)
    held = store.chain()
    before = (interval.start - dt.timedelta(days=1)).isoformat()
    if previous is None:
        last = max((d for d in held if d < interval.ds), default=None)
        if last is not None and last != before:
            raise ConstraintViolation(f"{interval.ds} cannot run: {before} is not published (the last day is {last})")
        previous = held[last]["path"] if last else None
    parent = held[before]["run"] if before in held else None
    state = spark.read.schema(schema).parquet(previous) if previous else empty_state(spark, schema)
    origin_day = in_interval(origin, interval, column)
    changes_day = in_interval(changes, interval, column)
    limit = broadcast_limit(spark)
    new_rows, new_bytes, all_rows, ud_bytes, digest = _measure_day(origin_day, changes_day, list(keys) if keys else ["id"])
    if previous and new_rows == 0 and all_rows == 0:
        # A quiet day: the state is unchanged and was checked when published.
        store.publish(interval.start, previous, parent, digest)
        return previous
    if strategy == "auto":
        strategy = "broadcast" if 0 <= limit and ud_bytes <= limit else "shuffle"
    if keys and new_rows:
        state = run_origin(state, origin, interval, column, keys, broadcast=0 <= limit and new_bytes <= limit)
    else:
        state = append_interval(state, origin, interval, column)
    merged = apply_changes(state, latest_per_key(changes_day), strategy=strategy, size_probe=changes_day)
    path = stage_checked(store, merged, interval.start, checks, keys)
    store.publish(interval.start, path, parent, digest)
    return path


def stage_checked(store: SnapshotStore, state: DataFrame, day: dt.date, checks: Mapping | None,
                  keys: Sequence[str] | None) -> str:
    """Write a state as the day's snapshot, not yet published; raise when a
    configured check or a constraint of the table does not hold. Both are
    observed while it is written."""
    constraints = ObservedConstraints(state, keys, RETAIL_LENGTHS) if keys else None
    observed = ObservedChecks(constraints.df if constraints else state, checks) if checks else None
    path = store.stage(observed.df if observed else constraints.df if constraints else state, day)
    if constraints:
        constraints.require(f"{day.isoformat()} breaks the table's constraints, snapshot not published")
    failed = observed.failures() if observed else []
    if failed:
        raise ConstraintViolation(f"checks failed for {day.isoformat()}, snapshot not published: "
                                  + "; ".join(f"{c}.{k}={a} not {op} {e}" for c, k, a, op, e in failed))
    return path


def replay(store: SnapshotStore, origin: DataFrame, changes: DataFrame, start: DateLike, end: DateLike,
           resume: bool = False, **kwargs) -> DataFrame:
    """Run every day of ``[start, end)`` in order (B6); returns the last state.
    Each day starts from the snapshot the day before wrote. With ``resume``,
    days already published in the span are skipped: the run continues after
    the newest published day (a replay cut short by a lost driver picks up
    where it stopped)."""
    span = Interval.parse(start, end)
    last = kwargs.pop("previous", None)
    days_ = list(span.days())
    if resume:
        done = store.latest_before(span.end)
        if done and dt.date.fromisoformat(done[0]) >= span.start:
            last = done[1]
            days_ = [d for d in days_ if d.start > dt.date.fromisoformat(done[0])]
    if not days_ and last is None:
        raise ValueError("empty replay span")
    for day in days_:
        last = run_day(store, origin, changes, day.start, previous=last, **kwargs)
    return store.spark.read.parquet(last)


def refresh(store: SnapshotStore, origin: DataFrame, changes: DataFrame, start: DateLike, end: DateLike,
            column: str = "invoicedate", **kwargs) -> tuple[DataFrame, list[str]]:
    """Bring every day of ``[start, end)`` up to date with its input: a day
    whose input digest and parent are those of its record is skipped, the first
    day that is new or changed and all days after it are run. One aggregate
    over the inputs (two rows a day) decides. Returns the last state and the
    days that ran."""
    span = Interval.parse(start, end)
    tagged = [in_interval(df, span, column).select(F.to_date(F.col(column)).cast("string").alias("ds"), F.lit(i).alias("tag"),
                                                   _row_hash(df).alias("h")) for i, df in enumerate((origin, changes))]
    found = {(r["ds"], r["tag"]): (r["n"], r["h"]) for r in tagged[0].unionByName(tagged[1]).groupBy("ds", "tag")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).collect()}
    held = store.chain()
    before = held.get((span.start - dt.timedelta(days=1)).isoformat())
    last, parent = (before["path"], before["run"]) if before else (None, None)
    ran = []
    for day in span.days():
        record = held.get(day.ds)
        digest = _digest(found.get((day.ds, 0), (0, 0)), found.get((day.ds, 1), (0, 0)))
        if not ran and record is not None and record["digest"] == digest and record["parent"] == parent:
            last, parent = record["path"], record["run"]
            continue
        last = run_day(store, origin, changes, day.start, column=column, previous=last, **kwargs)
        ran.append(day.ds)
    return store.spark.read.parquet(last), ran


def data_span(*frames_and_columns: tuple[DataFrame, str]) -> Interval:
    """The day span ``[min day, max day + 1)`` covered by the given columns:
    one pass over the columns, the bounds collected as observed metrics."""
    from pyspark.sql import Observation
    days_ = None
    for df, column in frames_and_columns:
        one = df.select(F.to_date(F.col(column)).alias("d"))
        days_ = one if days_ is None else days_.unionByName(one)
    obs = Observation("cdcmart_span")
    days_.observe(obs, F.min("d").alias("lo"), F.max("d").alias("hi")).write.format("noop").mode("overwrite").save()
    lo, hi = obs.get["lo"], obs.get["hi"]
    if lo is None:
        raise ValueError("no dated rows")
    return Interval(lo, hi + dt.timedelta(days=1))


# ----------------------------------------------------------------- demand -> material jobs

def run_extract(source: DataFrame, root: str, interval: Interval, dataset: str = "product_demand",
                column: str = "date", header: bool = True) -> None:
    """Extract one interval of product demand to the lake, replacing it."""
    write_interval(source, root, dataset, interval, column, fmt="csv", header=header)


def run_material_kg(spark: SparkSession, root: str, interval: Interval,
                    raw: str = "product_demand", out: str = "material_demand_kg",
                    table: str | None = None) -> DataFrame:
    """Lake -> frame recipe -> kg mart -> lake (B4); returns the interval's mart
    rows as the lake holds them. With ``table`` they are loaded into that mart
    table, which is created if absent, partitioned by date; the interval's days
    are replaced one partition each, all others are left alone. A load cut
    short is repeated."""
    demand = read_interval(spark, root, raw, DEMAND_SCHEMA, interval)
    write_interval(material_demand(demand, unit="kg"), root, out, interval, column="date", fmt="csv")
    mart = read_interval(spark, root, out, MATERIAL_KG_SCHEMA, interval)
    if table is not None:
        ensure_table(spark, table, MATERIAL_KG_SCHEMA, partition_by=("date",))
        replace_days(mart, table, interval, rebalance=False)  # the lake's files hold one day each
    return mart


def run_material_g(spark: SparkSession, source: DataFrame, target: DataFrame, interval: Interval,
                   root: str | None = None, out: str = "material_demand_g") -> DataFrame:
    """Slice -> SQL recipe -> grams mart -> (lake) -> upsert into ``target``."""
    mart = material_demand(in_interval(source, interval, "date"), unit="g")
    if root is not None:
        write_interval(mart, root, out, interval, column="date", fmt="csv")
    return upsert(target, mart, keys=("date", "shop_id", "material_name"))


def run_material_g_landing(source: DataFrame, landing: str, store: SnapshotStore, interval: Interval) -> str:
    """Source slice -> landing table -> SQL recipe -> upsert into the mart's
    newest snapshot -> publish -> clear the landing table (B5).

    A rerun starts with an empty landing table, so what a run cut short left
    there is not counted twice; the mart changes only when its snapshot is
    published. Returns the snapshot's folder."""
    spark = store.spark
    ensure_table(spark, landing, DEMAND_SCHEMA)
    clear(spark, landing)
    append(in_interval(source, interval, "date"), landing)
    mart = material_demand(read_table(spark, landing, interval), unit="g")
    held = store.newest()
    stored = (spark.read.schema(MATERIAL_G_SCHEMA).parquet(held[1]) if held
              else spark.createDataFrame([], MATERIAL_G_SCHEMA))
    path = store.write(upsert(stored, mart, keys=("date", "shop_id", "material_name")), interval.start)
    clear(spark, landing)
    return path


def rerun(store: SnapshotStore, origin: DataFrame, changes: DataFrame, ds: DateLike, **kwargs) -> DataFrame:
    """Run ``ds`` again from the day before it, then every later published day,
    whose state was built on the old one; returns the last state."""
    day = Interval.day(ds)
    before = store.latest_before(day.start)
    last = store.latest_before(dt.date.max)
    until = max(dt.date.fromisoformat(last[0]), day.start) if last else day.start
    return replay(store, origin, changes, day.start, until + dt.timedelta(days=1),
                  previous=before[1] if before else None, **kwargs)


def run_material_delta(spark: SparkSession, path: str, removed: DataFrame | None, added: DataFrame | None,
                       batch: str, recipe: str = "sql") -> DataFrame:
    """Load demand rows into a grams mart kept by signed deltas (B5): ``removed``
    are rows that an earlier load took in and that hold no more, ``added`` the
    rows that hold now (for an interval run again: its old and its new rows).
    Rows in both cancel; only the groups that differ change, and only their
    months are read and rewritten. A run cut short is repeated with the same
    ``batch``. Returns the mart."""
    load_delta(spark, path, signed_sums(added, removed, recipe), batch)
    return mart_rows(read_state(spark, path))


def run_day_bucketed(spark: SparkSession, table: str, result: str, origin: DataFrame, changes: DataFrame, ds: DateLike,
                     column: str = "invoicedate", checks: Mapping | None = RETAIL_CHECKS,
                     keys: Sequence[str] | None = ("id", "last_updated")) -> DataFrame:
    """One day's append and merge on a bucketed table: written as the bucketed
    table ``result``, which the next day starts from; returns it. Failing checks drop ``result`` and raise; ``table`` is never changed."""
    from ..sources.bucketed import bucket_spec, bucketed_target, create_bucketed
    interval = Interval.day(ds)
    by, buckets = bucket_spec(spark, table)
    state = run_origin(bucketed_target(spark, table), origin, interval, column, keys)
    latest = latest_per_key(in_interval(changes, interval, column))
    create_bucketed(apply_changes(state, latest, by), result, by, buckets)
    out = spark.table(result)
    if checks:
        failed = column_checks(out, checks).where(~F.col("passed")).collect()
        if failed:
            spark.sql(f"DROP TABLE {result}")
            raise ConstraintViolation(f"checks failed for {interval.ds}; table left unchanged: "
                                      + "; ".join(f"{r['column']}.{r['check']}={r['actual']}" for r in failed))
    return out


def replay_bucketed(spark: SparkSession, table: str, origin: DataFrame, changes: DataFrame, start: DateLike, end: DateLike,
                    buckets: int = 64, schema=RETAIL_SCHEMA, **kwargs) -> DataFrame:
    """Every day of ``[start, end)`` in order from an empty bucketed table; each
    day's table is ``table`` with the day's number, the last one is returned and
    the others are dropped once the next one stands."""
    from ..sources.bucketed import create_bucketed
    held = f"{table}_0"
    create_bucketed(spark.createDataFrame([], schema), held, "id", buckets)
    for n, day in enumerate(Interval.parse(start, end).days(), 1):
        run_day_bucketed(spark, held, f"{table}_{n}", origin, changes, day.start, **kwargs)
        spark.sql(f"DROP TABLE {held}")
        held = f"{table}_{n}"
    return spark.table(held)
