"""Latest change per key.

``latest_per_key`` keeps, for every key, the row that sorts first by
``order_by`` descending (NULLs first, as PostgreSQL orders ``DESC``), with
optional tie-break columns. It is written as ``row_number() = 1``, which
Catalyst plans as a partial ``WindowGroupLimit`` *before* the shuffle: each
map task already drops all but its own top row per key, so a key that holds a
third of all rows reaches the reducer as at most one row per map task.

``first_per_key`` gives what ``first_value(col) OVER w`` + ``DISTINCT`` gives,
as one aggregate instead of a window: the greatest ordered struct per key, in
which a NULL precedes every value and the carried columns settle ties. It is
partial, so whatever share of the rows a key holds, also when all of them tie,
one row per map task and key is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__cdcmart_rn"
_FIRST = "__cdcmart_first"


def _as_list(value: str | Sequence[str] | None) -> list[str]:
    if value is None:
        return []
    if isinstance(value, str):
        return [value]
    return list(value)


def _ordering(order_by: Sequence[str], tie_break: Sequence[str]) -> list[Column]:
    # DESC with NULLs first (PostgreSQL's default for DESC).
    return ([F.col(c).desc_nulls_first() for c in order_by]
            + [F.col(c).desc_nulls_first() for c in tie_break])


def latest_window(keys: Sequence[str], order_by: Sequence[str], tie_break: Sequence[str] = ()):
    return Window.partitionBy(*keys).orderBy(*_ordering(order_by, tie_break))


def latest_per_key(df: DataFrame, keys: str | Sequence[str] = "id",
                   order_by: str | Sequence[str] = "last_updated",
                   tie_break: str | Sequence[str] = ()) -> DataFrame:
    """One row per key: the latest by ``order_by`` (then ``tie_break``)."""
    keys, order_by, tie_break = _as_list(keys), _as_list(order_by), _as_list(tie_break)
    w = latest_window(keys, order_by, tie_break)
    return (df.withColumn(_RN, F.row_number().over(w))
              .where(F.col(_RN) == 1)
              .drop(_RN))


def first_per_key(df: DataFrame, keys: str | Sequence[str] = "id",
                  order_by: str | Sequence[str] = "last_updated",
                  columns: Sequence[str] | None = None, tie_break: str | Sequence[str] = ()) -> DataFrame:
    """``SELECT DISTINCT keys, first_value(c) OVER w ...`` with
    ``w = PARTITION BY keys ORDER BY order_by DESC``.

    ``columns`` are the carried columns (default: all non-key columns). Rows
    tied by ``order_by`` are told apart by ``tie_break`` and then by the carried
    columns in their order, each descending with NULLs first, so the result is
    the same at every run and that of ``latest_per_key`` with these tie breaks.
    """
    keys, order_by, tie_break = _as_list(keys), _as_list(order_by), _as_list(tie_break)
    if columns is None:
        columns = [c for c in df.columns if c not in keys]
    ranks = list(dict.fromkeys([*order_by, *tie_break, *columns]))
    place = {c: i for i, c in enumerate(ranks)}
    first = F.max(F.struct(*[part for i, c in enumerate(ranks)
                             for part in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"c{i}"))])).alias(_FIRST)
    return (df.groupBy(*keys).agg(first)
              .select(*keys, *[F.col(_FIRST)[f"c{place[c]}"].alias(c) for c in columns]))
