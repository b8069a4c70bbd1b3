"""Marts kept by signed deltas.

The sums of the material marts are invertible: the rows that an interval's
earlier load held enter negated, the rows it holds now enter as they are, and
only the (date, shop) groups in which they differ change. The state keeps per
group the number of demand rows and, per material, the sum and the number of
amounts that are known, so that a group without rows goes and a sum of only
NULL amounts is NULL again after known ones were taken back. Sums are decimals:
adding and taking back is exact, whatever the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.recipes import GRAMS_DECIMAL, MATERIALS, material_columns
from .materials import unpivot_materials

GROUP = ["date", "shop_id"]
ROWS = "n_rows"
KNOWN = {m: f"{m}_known" for m in MATERIALS}
_COUNTS = [ROWS, *KNOWN.values()]
STATE_COLUMNS = [*GROUP, *_COUNTS, *MATERIALS]


def signed_sums(added: DataFrame | None, removed: DataFrame | None = None, recipe: str = "sql", strict: bool = True) -> DataFrame:
    """The change of every group's state from demand rows that come and go: one
    partial aggregation; groups in which nothing changes are left out."""
    parts = []
    for sign, df in ((1, added), (-1, removed)):
        if df is not None:
            parts.append(df.select(*GROUP, *material_columns(recipe, strict=strict)).withColumn("sign", F.lit(sign)))
    if not parts:
        raise ValueError("rows that are added or removed are needed")
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    counts = [F.sum(F.col("sign").cast("long")).alias(ROWS)]
    counts += [F.sum(F.when(F.col(m).isNotNull(), F.col("sign")).otherwise(0).cast("long")).alias(k) for m, k in KNOWN.items()]
    sums = [F.coalesce(F.sum(F.when(F.col("sign") > 0, F.col(m)).otherwise(-F.col(m))), F.lit(0)).cast(GRAMS_DECIMAL).alias(m)
            for m in MATERIALS]
    changed = F.lit(False)
    for c in [*_COUNTS, *MATERIALS]:
        changed = changed | (F.col(c) != 0)
    return both.groupBy(*GROUP).agg(*counts, *sums).where(changed)


def add_delta(state: DataFrame, delta: DataFrame) -> DataFrame:
    """State plus delta: both hold one row a group, so this is one aggregation
    over the two. Groups left without rows stay, with zeros; ``mart_rows`` leaves them out."""
    both = state.select(*STATE_COLUMNS).unionByName(delta.select(*STATE_COLUMNS))
    return both.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in _COUNTS],
                                    *[F.sum(m).cast(GRAMS_DECIMAL).alias(m) for m in MATERIALS])


def mart_rows(state: DataFrame) -> DataFrame:
    """The grams mart of a state: what ``material_demand(unit="g")`` gives over
    all the rows that the state has taken in and not given back."""
    sums = [F.when(F.col(KNOWN[m]) > 0, F.col(m)).alias(m) for m in MATERIALS]
    return unpivot_materials(state.where(F.col(ROWS) > 0).select(*GROUP, *sums), GROUP, "material_name", "quantity_g")
