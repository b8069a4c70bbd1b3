"""Change capture: merge a change feed into a snapshot, append a day, upsert.

Merge semantics (one change row per key, already reduced to the latest):

    op        matched target row        no target row
    'I'       keep target               insert the change
    'U'       overwrite non-key columns ignore
    'D'       delete                    ignore
    other     keep target               ignore

Plan. A full outer join would shuffle the whole target and cannot be split by
AQE when one key is hot. Instead the merge is two joins that both scale:

* ``target LEFT JOIN (U/D changes)``: only updates and deletes touch existing
  rows, so only they are joined. Either a broadcast hash join (no target
  shuffle at all; chosen only when the U/D side's *measured* size is within
  the broadcast limit) or a shuffled join on the key (AQE splits a hot target
  key, the change side holds one row per key).
* ``(I changes) LEFT ANTI JOIN distinct(target keys)``: inserts need to know
  which keys exist. The target is read for its key columns only and first
  joined with the insert keys, so that only matching keys are made
  distinct and met by the inserts. The insert keys are broadcast or, when they
  do not fit, one hash table per shuffle partition: the target's keys stream
  past it, none of them is sorted or held, whatever share one key has.

Target rows keep their multiplicity (a U rewrites every row of that key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.interval import Interval, in_interval
from ..schemas import OP_DELETE, OP_INSERT, OP_UPDATE
from ..session import scratch_path
from .keys import require_key
from .latest import _as_list, latest_per_key
from .sizing import build_side, fits_broadcast, row_bytes

_M = "__cdcmart_matched"
_OP = "__cdcmart_op"
_NEW = "__cdcmart_new_"

STRATEGIES = ("auto", "broadcast", "shuffle")


def _truthy(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _pick_strategy(strategy: str, touching: DataFrame, broadcast_limit_bytes: int | None) -> str:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}: {strategy!r}")
    if strategy != "auto":
        return strategy
    return "broadcast" if fits_broadcast(touching, broadcast_limit_bytes) else "shuffle"


def apply_changes(target: DataFrame, changes: DataFrame, keys: str | Sequence[str] = "id",
                  op_col: str = "operation", strategy: str = "auto",
                  broadcast_limit_bytes: int | None = None,
                  upsert_unmatched_updates: bool = False,
                  size_probe: DataFrame | None = None,
                  materialize: bool = True) -> DataFrame:
    """Merge ``changes`` (one row per key) into ``target``.

    The output has ``target``'s columns in ``target``'s order. When ``target``
    has no ``op_col`` (the 10-column form) the operation is not stored.
    Two change rows for one key raise, as a database's MERGE does; NULL keys
    never match. Each side is broadcast only when that side's own measured
    size fits, so a first load (nearly all inserts) broadcasts no keys.
    ``upsert_unmatched_updates`` also inserts unmatched 'U' changes (off: the
    reference behaviour drops them).
    ``materialize``: the change set feeds two joins, so it is computed once
    and written as Parquet in the shared folder; all uses then see the same
    row of tied changes. With ``False`` the caller vouches for a change set
    that is one row per key and the same at every evaluation (``size_probe``
    may then bound its U/D size).
    """
    keys = _as_list(keys)
    cols = target.columns
    values = [c for c in cols if c not in keys]
    missing = [c for c in cols if c not in changes.columns]
    if missing:
        raise ValueError(f"changes lack target columns {missing}")
    op = F.col(op_col)
    if materialize:
        spark, path = changes.sparkSession, scratch_path(changes.sparkSession, "changes")
        changes.write.parquet(path)
        changes = spark.read.schema(changes.schema).parquet(path)
        require_key(changes, keys, allow_null=True)
    touching = changes.where(op.isin(OP_UPDATE, OP_DELETE))
    plan = _pick_strategy(strategy, touching if materialize or size_probe is None
                          else size_probe.where(op.isin(OP_UPDATE, OP_DELETE)), broadcast_limit_bytes)

    right = touching.select(*keys, op.alias(_OP), *[F.col(v).alias(_NEW + v) for v in values])
    right = right.withColumn(_M, F.lit(True))
    if plan == "broadcast":
        right = F.broadcast(right)
    joined = target.join(right, keys, "left")
    is_delete = _truthy(F.col(_M) & (F.col(_OP) == OP_DELETE))
    is_update = _truthy(F.col(_M) & (F.col(_OP) == OP_UPDATE))
    kept = joined.where(~is_delete).select(
        *[F.col(c) if c in keys else F.when(is_update, F.col(_NEW + c)).otherwise(F.col(c)).alias(c)
          for c in cols])

    insert_ops = [OP_INSERT, OP_UPDATE] if upsert_unmatched_updates else [OP_INSERT]
    candidates = changes.where(op.isin(*insert_ops))
    # one candidate a key: an inner join finds what a semi-join would
    known = target.select(*keys).join(build_side(candidates.select(*keys), broadcast_limit_bytes), keys).distinct()
    inserted = candidates.join(known, keys, "left_anti").select(*cols)
    return kept.unionByName(inserted)


def _outcome(op: Column, matched: Column) -> Column:
    return (F.when(matched & (op == OP_DELETE), "delete")
             .when(matched & (op == OP_UPDATE), "update")
             .when(matched, "matched_noop")
             .when(op == OP_INSERT, "insert")
             .otherwise("unmatched_ignored"))


def _key_counts(target: DataFrame, keys: list[str]) -> DataFrame:
    """How many target rows carry each key. The keys are counted in the map
    tasks before any join, so of a hot key a join sees one row."""
    return target.groupBy(*keys).agg(F.count(F.lit(1)).alias("target_rows"))


def classify_changes(target: DataFrame, changes: DataFrame, keys: str | Sequence[str] = "id",
                     op_col: str = "operation") -> DataFrame:
    """Outcome per change row: keys, operation, matched, target_rows, outcome.

    ``target_rows`` is how many target rows carry the key (the rows a delete
    or update touches). Outcomes: delete, update, matched_noop, insert,
    unmatched_ignored.
    """
    keys = _as_list(keys)
    out = changes.select(*keys, F.col(op_col).alias("operation")).join(_key_counts(target, keys), keys, "left")
    matched = F.col("target_rows").isNotNull()
    return out.select(*keys, "operation", matched.alias("matched"),
                      F.coalesce(F.col("target_rows"), F.lit(0)).cast("bigint").alias("target_rows"),
                      _outcome(F.col("operation"), matched).alias("outcome"))


def merge_outcomes(target: DataFrame, changes: DataFrame, keys: str | Sequence[str] = "id",
                   op_col: str = "operation") -> DataFrame:
    """Counts per outcome: matched outcomes count target rows, unmatched ones
    count change rows, plus ``untouched`` target rows (no change for the key;
    always a row, 0 if there are none)."""
    keys = _as_list(keys)
    told = changes.select(*keys, F.col(op_col).alias(_OP), F.lit(True).alias(_M))
    met = _key_counts(target, keys).join(told, keys, "full")
    n = F.coalesce(F.col("target_rows"), F.lit(1)).cast("bigint")
    changed = _truthy(F.col(_M))
    counted = (met.select(F.when(changed, _outcome(F.col(_OP), F.col("target_rows").isNotNull())).otherwise("untouched")
                          .alias("outcome"), n.alias("n"))
               .unionByName(changes.sparkSession.range(1).select(F.lit("untouched").alias("outcome"), F.lit(0).cast("bigint").alias("n"))))
    return counted.groupBy("outcome").agg(F.sum("n").alias("n"))


def cdc_interval(target: DataFrame, changes: DataFrame, interval: Interval | None = None,
                 column: str = "invoicedate", keys: str | Sequence[str] = "id",
                 order_by: str | Sequence[str] = "last_updated", tie_break: Sequence[str] = (),
                 op_col: str = "operation", strategy: str = "auto",
                 broadcast_limit_bytes: int | None = None,
                 upsert_unmatched_updates: bool = False) -> DataFrame:
    """Slice the feed (filter before the window), keep the latest change per
    key inside the slice, merge it. ``interval=None`` merges the whole feed."""
    sliced = changes if interval is None else in_interval(changes, interval, column)
    latest = latest_per_key(sliced, keys, order_by, tie_break)
    return apply_changes(target, latest, keys, op_col, strategy, broadcast_limit_bytes,
                         upsert_unmatched_updates, size_probe=sliced)


def append_interval(target: DataFrame, source: DataFrame, interval: Interval,
                    column: str = "invoicedate") -> DataFrame:
    """``INSERT INTO target SELECT cols FROM source WHERE column in interval``.

    No dedupe (a bare insert); run ``require_key`` on the result to enforce
    the target key as the database would.
    """
    return target.unionByName(in_interval(source, interval, column).select(*target.columns))


def upsert(target: DataFrame, source: DataFrame,
           keys: Sequence[str] = ("date", "shop_id", "material_name"), check: bool = True,
           broadcast_limit_bytes: int | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE`` all columns.

    A key repeated inside ``source`` is an error (as a database raises when a
    row would be affected twice); ``check`` enforces it before the merge.
    NULL key parts never conflict. The source keys' size is measured while the
    source is written; they are broadcast to the anti join only when it fits
    the broadcast limit (a daily batch against a large mart: the mart is then
    never shuffled), else looked up in hash tables by shuffle partition while
    these are small, so that the mart is not sorted.
    """
    keys = list(keys)
    spark, path = source.sparkSession, scratch_path(source.sparkSession, "upsert")
    size = Observation("cdcmart_upsert")
    told = source.observe(size, F.sum(row_bytes(source.select(*keys))).alias("b"))
    told.write.parquet(path)  # computed once: it is checked, measured, joined and added
    source = spark.read.schema(source.schema).parquet(path)
    if check:
        require_key(source, keys, allow_null=True)
    source_keys = build_side(source.select(*keys), broadcast_limit_bytes, int(size.get.get("b") or 0))
    kept = target.join(source_keys, keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def merge_into_table(changes: DataFrame, table: str, keys: str | Sequence[str] = "id",
                     op_col: str = "operation") -> None:
    """The same outcome table as ``apply_changes`` as a table MERGE, for
    catalogs whose tables support row-level changes (``DataFrame.mergeInto``).
    ``changes`` holds one row per key. File-based tables (plain Parquet) do
    not support MERGE; use ``apply_changes`` and a snapshot there."""
    keys = _as_list(keys)
    cols = changes.sparkSession.table(table).columns
    src = changes.alias("cdcmart_src")
    cond = None
    for k in keys:
        term = F.col(f"cdcmart_src.{k}") == F.col(f"{table}.{k}")
        cond = term if cond is None else cond & term
    op = F.col(f"cdcmart_src.{op_col}")
    new = {c: F.col(f"cdcmart_src.{c}") for c in cols}
    (src.mergeInto(table, cond)
        .whenMatched(op == OP_DELETE).delete()
        .whenMatched(op == OP_UPDATE).update({c: v for c, v in new.items() if c not in keys})
        .whenNotMatched(op == OP_INSERT).insert(new)
        .merge())
