"""Product tier -> grams of three coffee beans per unit of demand.

Two recipes exist and differ on tiers they do not name (and on a NULL tier,
which falls through every ``tier = 'x'`` test exactly like an unknown tier):

* ``sql``   : the CASE form of the grams mart.
* ``frame`` : the row-lambda form of the kilogram mart.

Each recipe is a fixed table ``tier -> (local_arabica, foreign_arabica,
robusta)`` plus the row for every other tier. It becomes one CASE chain per
material (native expressions, whole-stage codegen, no UDF). A zero entry is
the literal 0 (so a NULL demand gives 0 there, NULL elsewhere).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exact import LIMBS, is_number, limbs

# Materials in output order.
MATERIALS = ("local_arabica", "foreign_arabica", "robusta")

# Grams per unit of demand, (local_arabica, foreign_arabica, robusta).
RECIPES = {
    "sql": {
        "tiers": {"cheap": (20, 0, 0), "medium": (10, 10, 0)},
        "other": (0, 10, 10),
    },
    "frame": {
        "tiers": {"cheap": (20, 0, 0), "medium": (10, 10, 0), "expensive": (0, 10, 10)},
        "other": (10, 0, 10),
    },
}

DEMAND_DECIMAL = T.DecimalType(18, 4)
_WIDE = T.DecimalType(38, 18)
GRAMS_DECIMAL = T.DecimalType(38, 4)


def demand_number(demand: str | Column = "demand", strict: bool = True) -> Column:
    """Demand text -> decimal(18,4). A text that is no number, or that does not
    fit four decimals exactly, is bad: ``strict`` raises on it whatever the
    session's ANSI setting, otherwise it becomes NULL. ``exact_material_demand``
    takes numbers without that bound."""
    c = F.col(demand) if isinstance(demand, str) else demand
    number = c.try_cast(DEMAND_DECIMAL)
    exact = F.when(number == c.try_cast(_WIDE), number)
    if not strict:
        return exact
    return F.when(c.isNull(), F.lit(None)).otherwise(F.coalesce(exact, F.raise_error(
        F.concat(F.lit("not an exact demand: "), c.cast("string"))).cast(DEMAND_DECIMAL)))


def material_limbs(recipe: str = "sql", tier: str = "product_name", demand: str = "demand", strict: bool = True) -> dict[str, Column]:
    """The exact grams of each material as limbs (see ``exact``), for demand of
    any size and scale. A text that is no number raises (``strict``) or is null."""
    spec, t = RECIPES[recipe], F.col(tier)
    number = checked_number(demand) if strict else F.col(demand)

    def chain(i: int) -> Column:
        term = lambda factor: F.array().cast(LIMBS) if factor == 0 else limbs(number, factor)
        expr = F
        for name, factors in spec["tiers"].items():
            expr = expr.when(t == F.lit(name), term(factors[i]))
        return expr.otherwise(term(spec["other"][i]))
    return {m: chain(i) for i, m in enumerate(MATERIALS)}


def material_factors(recipe: str = "sql", tier: str = "product_name") -> dict[str, Column]:
    """The grams of each material a unit of demand takes, by tier."""
    def chain(i: int) -> Column:
        expr = F
        for name, factors in RECIPES[recipe]["tiers"].items():
            expr = expr.when(F.col(tier) == F.lit(name), F.lit(factors[i]))
        return expr.otherwise(F.lit(RECIPES[recipe]["other"][i]))
    return {m: chain(i) for i, m in enumerate(MATERIALS)}


def checked_number(demand: str = "demand") -> Column:
    """Demand text as it is; text that is no number raises."""
    d = F.col(demand)
    return F.when(d.isNull() | is_number(d), d).otherwise(F.raise_error(F.concat(F.lit("not a number: "), d)).cast("string"))


def split_rejects(df: DataFrame, path: str, demand: str = "demand") -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The rows whose demand is a number (or null) and those whose demand is
    other text, and how many of each: one scan of ``df``, one write to two
    folders under ``path``, counted while it is written."""
    rejected = F.coalesce(~is_number(F.col(demand)), F.lit(False))
    counts = Observation("cdcmart_rejects")
    told = df.withColumn("rejected", rejected).observe(
        counts, F.count(F.when(~F.col("rejected"), 1)).alias("good"), F.count(F.when(F.col("rejected"), 1)).alias("rejected"))
    told.write.partitionBy("rejected").parquet(path)
    spark = df.sparkSession
    both = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("rejected", T.BooleanType())])).parquet(path)
    return both.where(~F.col("rejected")).drop("rejected"), both.where("rejected").drop("rejected"), dict(counts.get)


def _grams(tier: Column, amount: Column, recipe: str, index: int) -> Column:
    try:
        spec = RECIPES[recipe]
    except KeyError:
        raise ValueError(f"recipe must be one of {sorted(RECIPES)}: {recipe!r}") from None

    def term(factor: int) -> Column:
        return F.lit(0).cast(GRAMS_DECIMAL) if factor == 0 else (amount * F.lit(factor)).cast(GRAMS_DECIMAL)

    expr = None
    for name, factors in spec["tiers"].items():
        cond = tier == F.lit(name)
        expr = F.when(cond, term(factors[index])) if expr is None else expr.when(cond, term(factors[index]))
    return expr.otherwise(term(spec["other"][index]))


def material_columns(recipe: str = "sql", tier: str = "product_name", demand: str = "demand",
                     strict: bool = True) -> list[Column]:
    """The three material columns (grams, decimal(38,4)) for ``recipe``."""
    return gram_columns(F.col(tier), demand_number(demand, strict), recipe)


def gram_columns(tier: Column, amount: Column, recipe: str = "sql") -> list[Column]:
    """The three material columns of an amount that is a number already."""
    return [_grams(tier, amount, recipe, i).alias(m) for i, m in enumerate(MATERIALS)]


def expand_materials(df: DataFrame, recipe: str = "sql", strict: bool = True,
                     tier: str = "product_name", demand: str = "demand") -> DataFrame:
    """Add ``local_arabica``, ``foreign_arabica``, ``robusta`` grams to every row."""
    return df.select("*", *material_columns(recipe, tier, demand, strict))


def demand_rejects(df: DataFrame, demand: str = "demand") -> DataFrame:
    """Rows whose demand text is present but is not a number."""
    return df.where(F.col(demand).isNotNull() & demand_number(demand, strict=False).isNull())
