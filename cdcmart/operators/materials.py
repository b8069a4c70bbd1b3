"""Raw-material demand marts.

Both marts are one plan: scan -> expand (CASE per material) -> aggregate the
three material sums per (date, shop) -> unpivot to long form. Summing before
the unpivot equals unpivot-then-sum (each long row's group is its wide row's
group) and shuffles one row per wide row instead of three; the aggregation is
partial (map-side) so hot shops or days are pre-reduced before the shuffle.

* grams mart (``unit="g"``, SQL recipe by default): groups keep a NULL shop;
  a sum of only NULL amounts is NULL. Columns
  ``date, shop_id, material_name, quantity_g``.
* kilogram mart (``unit="kg"``, frame recipe by default): rows with a NULL
  date or shop are dropped, sums skip NULLs (0 when none), grams / 1000, date
  becomes DATE. Columns ``date, shop_id, raw_material, demand_kg``.

Every (date, shop) yields three rows, zeros included. Grouping is on the full
``date`` value (``grain="day"`` truncates it to the day first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact import from_limbs, limbs, sum_products
from ..functions.recipes import GRAMS_DECIMAL, MATERIALS, checked_number, demand_number, gram_columns, material_factors
from ..session import scratch_path

_RANK = "__cdcmart_material_rank"
_PLACE = "__cdcmart_place"
_AMOUNT = "__cdcmart_amount"
KG_DECIMAL = T.DecimalType(38, 7)


def unpivot_materials(df: DataFrame, id_cols: Sequence[str], name_col: str = "material_name",
                      value_col: str = "quantity", materials: Sequence[str] = MATERIALS) -> DataFrame:
    """Wide material columns -> long rows (one Expand over a single scan)."""
    return df.unpivot(list(id_cols), list(materials), name_col, value_col)


def material_demand(df: DataFrame, unit: str = "g", recipe: str | None = None,
                    strict: bool = True, grain: str = "timestamp", as_text: bool = False,
                    sorted: bool = False) -> DataFrame:
    """Long-form material demand from product demand rows
    (``shop_id, date, product_name, demand``)."""
    if unit not in ("g", "kg"):
        raise ValueError(f"unit must be 'g' or 'kg': {unit!r}")
    recipe = recipe or ("sql" if unit == "g" else "frame")
    date = F.col("date")
    if grain == "day":
        date = F.date_trunc("day", date).cast(df.schema["date"].dataType)
    elif grain != "timestamp":
        raise ValueError(f"grain must be 'timestamp' or 'day': {grain!r}")
    # each demand is read as a number once, not in every branch of every material
    read = df.select(date.alias("date"), "shop_id", "product_name", demand_number(strict=strict).alias(_AMOUNT))
    wide = read.select("date", "shop_id", *gram_columns(F.col("product_name"), F.col(_AMOUNT), recipe))
    if unit == "kg":
        wide = wide.where(F.col("date").isNotNull() & F.col("shop_id").isNotNull())
        sums = [F.coalesce(F.sum(m), F.lit(0).cast(GRAMS_DECIMAL)).alias(m) for m in MATERIALS]
    else:
        sums = [F.sum(m).cast(GRAMS_DECIMAL).alias(m) for m in MATERIALS]
    per_shop = wide.groupBy("date", "shop_id").agg(*sums)
    if unit == "g":
        out = unpivot_materials(per_shop, ["date", "shop_id"], "material_name", "quantity_g")
        value = F.col("quantity_g").cast(GRAMS_DECIMAL)
        out = out.select("date", "shop_id", "material_name",
                         (value.cast("string") if as_text else value).alias("quantity_g"))
        if sorted:
            out = out.orderBy("date", "shop_id", "material_name")
        return out
    out = unpivot_materials(per_shop, ["date", "shop_id"], "raw_material", "demand_g")
    kg = (F.col("demand_g").cast(T.DecimalType(30, 4)) * F.lit(0.001).cast(T.DecimalType(3, 3))).cast(KG_DECIMAL)
    out = out.select(F.col("date").cast(T.DateType()).alias("date"), "shop_id", "raw_material",
                     (kg.cast("string") if as_text else kg).alias("demand_kg"))
    if sorted:
        out = ordered(out)
    return out


def exact_material_demand(df: DataFrame, unit: str = "g", recipe: str | None = None, strict: bool = True) -> DataFrame:
    """``material_demand`` for demand of any size and scale: the same groups
    and rows, the amounts added up without bound and given as plain decimal
    text (the marts' own column type)."""
    if unit not in ("g", "kg"):
        raise ValueError(f"unit must be 'g' or 'kg': {unit!r}")
    grams = material_factors(recipe or ("sql" if unit == "g" else "frame"))
    number = checked_number() if strict else F.col("demand")
    if unit == "g":
        sums = sum_products(df, ["date", "shop_id"], number, grams)
        return unpivot_materials(sums, ["date", "shop_id"], "material_name", "quantity_g")
    known = df.where(F.col("date").isNotNull() & F.col("shop_id").isNotNull())
    out = unpivot_materials(sum_products(known, ["date", "shop_id"], number, grams), ["date", "shop_id"], "raw_material", "grams")
    kg = from_limbs(limbs(F.concat(F.coalesce("grams", F.lit("0")), F.lit("e-3"))))
    return out.select(F.col("date").cast(T.DateType()).alias("date"), "shop_id", "raw_material", kg.alias("demand_kg"))


def ordered(df: DataFrame, name_col: str = "raw_material") -> DataFrame:
    """Material-major order (the melt order): material, then date, then shop."""
    rank = F.array_position(F.array(*[F.lit(m) for m in MATERIALS]), F.col(name_col))
    return df.withColumn(_RANK, rank).orderBy(_RANK, "date", "shop_id").drop(_RANK)


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """``df`` (a sorted frame) with each row's place in the order, from 1.

    The rows are written once with their number inside their partition; only
    the row counts of the partitions are added up over the whole, so no task
    holds more than its own rows."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "sorted")
    df.withColumn(_PLACE, F.monotonically_increasing_id()).write.parquet(path)
    part = F.shiftright(_PLACE, 33).alias("__part")
    numbered = spark.read.parquet(path).withColumn("__part", part)
    sizes = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    place = F.col("__before") + F.col(_PLACE).bitwiseAND((1 << 33) - 1) + 1
    return numbered.join(before, "__part").select(*[F.col(c) for c in df.columns], place.alias(name))
