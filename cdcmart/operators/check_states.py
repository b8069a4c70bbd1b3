"""Column checks from states that are kept with a snapshot.

A state holds, per part of the table (say a month) and checked column, the
number of rows and of NULLs and the least and greatest value, each with the
number of rows that hold it. Rows that a merge takes out or puts in change the
counts by their sign. A value below the least one becomes the least one; taking
the least one out lowers its count, and only when that count reaches zero are
the part's rows read again. So a day's checks read the day's changed rows and
the parts that lost an extreme value, not the table.

Counts of distinct values cannot be kept this way; a check that needs them is refused.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checks import _flatten, _plan, _report

PART, COLUMN = "part", "column"
KEY = [PART, COLUMN]
STATE_COLUMNS = [*KEY, "n_rows", "n_nulls", "lo", "lo_count", "hi", "hi_count"]


def _checked(mapping: Mapping) -> dict[str, set[str]]:
    """The checks of every checked column."""
    found: dict[str, set[str]] = {}
    for column, check, *_ in _flatten(mapping):
        if check not in ("null_check", "min", "max"):
            raise ValueError(f"check {column}.{check} cannot be kept as a state")
        found.setdefault(column, set()).add(check)
    return found


def _part(part: str) -> Column:
    """``part`` is a SQL expression over the table's columns."""
    return F.coalesce(F.expr(part).cast("string"), F.lit(""))


def _values(df: DataFrame, mapping: Mapping, part: str, *more: Column) -> DataFrame:
    """One row per row of ``df`` and checked column: part, column, missing,
    value (only where its least or greatest is asked for)."""
    rows = [F.struct(F.lit(c).alias(COLUMN), F.col(c).isNull().alias("missing"),
                     (F.col(c).cast("double") if checks - {"null_check"} else F.lit(None).cast("double")).alias("value"))
            for c, checks in _checked(mapping).items()]
    return df.select(_part(part).alias(PART), *more, F.inline(F.array(*rows)))


def check_states(df: DataFrame, mapping: Mapping, part: str) -> DataFrame:
    """The states of a whole table; rows whose ``part`` is NULL are one part.

    Two scans of the checked columns, both with partial aggregation: the
    bounds (one row a part and column), then the rows that hold them."""
    values = _values(df, mapping, part)
    bounds = values.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("missing").alias("n_nulls"),
                                      F.min("value").alias("lo"), F.max("value").alias("hi"))
    held = (values.join(bounds.select(*KEY, "lo", "hi"), KEY).where("value = lo OR value = hi").groupBy(*KEY)
            .agg(F.count_if(F.expr("value = lo")).alias("lo_count"), F.count_if(F.expr("value = hi")).alias("hi_count")))
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("lo_count", "hi_count")]
    return bounds.join(held, KEY, "left").select(*[c for c in STATE_COLUMNS if not c.endswith("_count")], *counts).select(*STATE_COLUMNS)


def _changed(removed: DataFrame, added: DataFrame, mapping: Mapping, part: str) -> DataFrame:
    """Signed rows per part, column and value; what is taken out and put back cancels."""
    both = (_values(removed, mapping, part, F.lit(-1).alias("sign"))
            .unionByName(_values(added, mapping, part, F.lit(1).alias("sign"))))
    return (both.groupBy(*KEY, "missing", "value").agg(F.sum(F.col("sign").cast("long")).alias("n")).where("n <> 0"))


def _extreme(held: str, beyond: str, pick) -> list[Column]:
    """Changes at the held extreme, and the outermost value beyond it with its rows."""
    past = F.expr(f"n > 0 AND ({held} IS NULL OR value {beyond} {held})")
    return [F.sum(F.when(F.expr(f"value = {held}"), F.col("n")).otherwise(0)).alias(f"{held}_change"),
            (F.min if beyond == "<" else F.max)(F.when(past, F.col("value"))).alias(f"{held}_new"),
            pick(F.col("n"), F.when(past, F.col("value"))).alias(f"{held}_new_count")]


def advance_states(held: DataFrame, removed: DataFrame, added: DataFrame, mapping: Mapping, part: str) -> DataFrame:
    """The states after rows went and came, with a column ``open``: true where
    an extreme value went with its last row and the part must be read again.

    ``removed`` and ``added`` may share rows that did not change. The states
    are small (parts times columns); the work follows the changed rows."""
    changed = _changed(removed, added, mapping, part)
    delta = (changed.join(held.select(*KEY, "lo", "hi"), KEY, "left").groupBy(*KEY)
             .agg(F.sum("n").alias("d_rows"), F.sum(F.when(F.col("missing"), F.col("n")).otherwise(0)).alias("d_nulls"),
                  *_extreme("lo", "<", F.min_by), *_extreme("hi", ">", F.max_by)))
    both = held.join(delta, KEY, "full")
    zero = F.lit(0).cast("long")
    n_rows = F.coalesce("n_rows", zero) + F.coalesce("d_rows", zero)
    n_nulls = F.coalesce("n_nulls", zero) + F.coalesce("d_nulls", zero)
    left = {e: F.coalesce(f"{e}_count", zero) + F.coalesce(f"{e}_change", zero) for e in ("lo", "hi")}
    out, lost = [], F.lit(False)
    for e in ("lo", "hi"):
        new = F.col(f"{e}_new")
        gone = new.isNull() & F.col(e).isNotNull() & (left[e] <= 0)
        lost = lost | gone
        out += [F.when(new.isNotNull(), new).when(~gone, F.col(e)).alias(e),
                F.when(new.isNotNull(), F.col(f"{e}_new_count")).when(~gone, left[e]).otherwise(zero).alias(f"{e}_count")]
    # without any value left there is nothing to read again
    return (both.select(*KEY, n_rows.alias("n_rows"), n_nulls.alias("n_nulls"), *out, (lost & (n_rows > n_nulls)).alias("open"))
            .where("n_rows <> 0").select(*STATE_COLUMNS, "open"))


def settle_states(advanced: DataFrame, table: DataFrame, mapping: Mapping, part: str) -> DataFrame:
    """``advance_states`` with its open parts taken from ``table``, the table
    after the change; rows of other parts are left out before anything is
    aggregated (``part`` should be what the table is partitioned by, so that
    they are not read). ``advanced`` is used twice: write it first."""
    names = advanced.where("open").select(F.col(PART).alias("open_part")).distinct()
    again = table.join(names, _part(part) == F.col("open_part"), "left_semi")
    closed = advanced.join(names, F.col(PART) == F.col("open_part"), "left_anti")
    return closed.select(*STATE_COLUMNS).unionByName(check_states(again, mapping, part))


def state_report(states: DataFrame, mapping: Mapping, accept_none: bool = True) -> DataFrame:
    """The report ``column_checks`` gives over the whole table, from its states."""
    _checked(mapping)
    specs, aliases, _ = _plan(mapping)
    value = {"null_check": (F.sum, "n_nulls"), "min": (F.min, "lo"), "max": (F.max, "hi")}
    aggs = [value[check][0](F.when(F.col(COLUMN) == column, F.col(value[check][1]))).cast("double").alias(alias)
            for (column, check), alias in aliases.items()]
    return _report(states.agg(*aggs), specs, aliases, accept_none)
