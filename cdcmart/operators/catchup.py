"""Catch-up: the state after a span of days in one pass, equal to running the
daily append + merge for every day in order.

Why it is exact. Every update or delete hits *all* live rows of a key, so per
key the history reduces to a live/dead state machine over at most two events
per day: "origin rows were appended" (phase 0) and "the day's latest change"
(phase 1). A change 'I' inserts only when the key is dead just before it; 'A'
and 'I' make the key live, 'D' makes it dead, 'U' and others leave it as is.
A key with a NULL part never matches, so its 'I' changes always insert and
its 'U'/'D' changes touch nothing. Then, for every row (appended on its
invoice day, or inserted on its change day):

* it is deleted iff some day's latest change is 'D' on or after its birth day
  (i.e. the key's last 'D' day >= birth day);
* otherwise its values are those of the key's last 'U' if that is on or after
  its birth day, else its own.

Plan. Latest change per (key, day) is reduced map-side (partial
``WindowGroupLimit``); the append events are a partial-aggregated DISTINCT;
the liveness window runs over the compact per-key event list (at most two
rows per key per day, whatever the data volume, so a hot key cannot overload
a task) and yields the inserted rows directly (each change event carries its
row); the per-key summary (last D day, last U row) is a partial
aggregation; rows meet their key's summary in one equi-join, broadcast only
when the summary's measured size fits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.interval import DateLike, Interval, in_interval
from ..schemas import OP_DELETE, OP_INSERT, OP_UPDATE
from ..session import shared_dir
from .latest import _as_list, latest_per_key
from .sizing import fits_broadcast

_DAY, _PHASE, _KIND, _BIRTH = "__cdcmart_day", "__cdcmart_phase", "__cdcmart_kind", "__cdcmart_birth"
_LAST_D, _LAST_U = "__cdcmart_last_d", "__cdcmart_last_u"
_ROW, _PREV = "__cdcmart_row", "__cdcmart_prev"


def catch_up(origin: DataFrame, changes: DataFrame, start: DateLike, end: DateLike,
             column: str = "invoicedate", keys: str | Sequence[str] = "id",
             order_by: str | Sequence[str] = "last_updated", tie_break: Sequence[str] = (),
             op_col: str = "operation", initial: DataFrame | None = None,
             broadcast_limit_bytes: int | None = None, materialize: bool = True) -> DataFrame:
    """State after every day of ``[start, end)``: day by day, origin rows of
    the day are appended and the day's latest change per key is merged.
    ``initial`` is the state before ``start`` (default: empty).
    ``materialize`` writes the per-(key, day) latest changes once as a
    reliable checkpoint (they feed three steps; the feed is then scanned and
    shuffled once)."""
    keys, order_by = _as_list(keys), _as_list(order_by)
    span = Interval.parse(start, end)
    cols = (initial.columns if initial is not None else origin.columns)
    values = [c for c in cols if c not in keys]
    day_of = F.to_date(F.col(column))

    # Rows born by appending: the origin rows of the span (+ the initial state, born before it).
    born = in_interval(origin, span, column).select(*cols, day_of.alias(_BIRTH))
    if initial is not None:
        before = F.lit((span.start - dt.timedelta(days=1)).isoformat()).cast("date")
        born = initial.select(*cols, before.alias(_BIRTH)).unionByName(born)

    # The latest change per key and day (one row per key-day).
    sliced = in_interval(changes, span, column).withColumn(_DAY, day_of)
    latest = latest_per_key(sliced, keys + [_DAY], order_by, tie_break)
    if materialize:
        shared_dir(latest.sparkSession)
        latest = latest.checkpoint(eager=True)

    # Liveness just before each day's change: the last of A / I / D events before it.
    # Each change event carries its row, so the inserts come straight out of the window.
    appends = born.select(*keys, F.col(_BIRTH).alias(_DAY)).distinct() \
                  .select(*keys, _DAY, F.lit(0).alias(_PHASE), F.lit("A").alias(_KIND),
                          F.lit(None).cast(latest.select(F.struct(*cols)).schema[0].dataType).alias(_ROW))
    change_events = latest.select(*keys, _DAY, F.lit(1).alias(_PHASE), F.col(op_col).alias(_KIND),
                                  F.struct(*cols).alias(_ROW))
    events = appends.unionByName(change_events)
    w = (Window.partitionBy(*keys).orderBy(_DAY, _PHASE)
         .rowsBetween(Window.unboundedPreceding, -1))
    life = F.when(F.col(_KIND).isin("A", OP_INSERT, OP_DELETE), F.col(_KIND))
    prev = F.last(life, ignorenulls=True).over(w)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()  # a NULL key never matches: an 'I' always inserts
    # The window runs over all events (appends carry the liveness); filter after it.
    inserted = (events.withColumn(_PREV, prev)
                .where((F.col(_PHASE) == 1) & (F.col(_KIND) == OP_INSERT)
                       & (F.col(_PREV).isNull() | (F.col(_PREV) == OP_DELETE) | null_key))
                .select(*[F.col(f"{_ROW}.{c}").alias(c) for c in cols], F.col(_DAY).alias(_BIRTH)))
    rows = born.unionByName(inserted)

    # Per key: the last delete day and the last update (its day and values).
    upd = F.when(F.col(op_col) == OP_UPDATE, F.struct(F.col(_DAY).alias("day"), *[F.col(v) for v in values]))
    summary = latest.groupBy(*keys).agg(
        F.max(F.when(F.col(op_col) == OP_DELETE, F.col(_DAY))).alias(_LAST_D),
        F.max_by(upd, F.when(upd.isNotNull(), F.col(_DAY))).alias(_LAST_U))
    summary = summary.where(F.col(_LAST_D).isNotNull() | F.col(_LAST_U).isNotNull())
    if fits_broadcast(summary, broadcast_limit_bytes):
        summary = F.broadcast(summary)

    joined = rows.join(summary, keys, "left")
    alive = F.col(_LAST_D).isNull() | (F.col(_LAST_D) < F.col(_BIRTH))
    updated = F.col(_LAST_U).isNotNull() & (F.col(f"{_LAST_U}.day") >= F.col(_BIRTH))
    return joined.where(alive).select(
        *[F.col(c) if c in keys else F.when(updated, F.col(f"{_LAST_U}.{c}")).otherwise(F.col(c)).alias(c)
          for c in cols])
