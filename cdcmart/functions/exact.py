"""Numbers as text of any size and scale, added up exactly.

A decimal type ends at 38 digits; a database's unbounded NUMERIC does not. A
number is cut into limbs of nine decimal digits, each with its place (limb 0
ends at the decimal point). Limbs of one place add up on their own as plain
aggregates, so a sum of any numbers is one partial aggregation by (keys,
place); the carries are settled once, in the sums. All of it is built-in
functions. Results are plain decimal text without needless zeros.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 9
_BASE = 10 ** WIDTH
#: limbs above the highest one that a sum of 38 digits a limb may carry into
_CARRIED = 5
NUMBER = r"^\s*[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d{1,6})?\s*$"
_SPACE = " \t\n\x0b\f\r"
LIMBS = "array<struct<place:int,value:decimal(38,0)>>"


def is_number(text: Column) -> Column:
    """Digits with an optional sign, point and exponent; null for null."""
    return text.rlike(NUMBER)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def limbs(text: Column, factor: int = 1) -> Column:
    """The limbs of a number times a factor; null for null and for other text."""
    def halves(plain: Column) -> Column:
        """Mantissa and exponent of a number without the space around it."""
        lower = F.lower(plain)
        return F.struct(F.split_part(lower, F.lit("e"), F.lit(1)).alias("mantissa"), F.split_part(lower, F.lit("e"), F.lit(2)).alias("exponent"))

    def parts(h: Column) -> Column:
        unsigned = F.ltrim(h["mantissa"], F.lit("+-"))
        return F.struct(F.startswith(h["mantissa"], F.lit("-")).alias("negative"), F.split_part(unsigned, F.lit("."), F.lit(1)).alias("whole"),
                        F.split_part(unsigned, F.lit("."), F.lit(2)).alias("fraction"), h["exponent"].alias("exponent"))

    def digits(p: Column) -> Column:
        scale = F.length(p["fraction"]) - F.coalesce(F.nullif(p["exponent"], F.lit("")).cast("int"), F.lit(0))
        spare = F.pmod(-scale, F.lit(WIDTH))
        return F.struct(F.concat(p["whole"], p["fraction"], F.repeat(F.lit("0"), spare)).alias("all"),
                        (-((scale + spare) / WIDTH)).cast("int").alias("lowest"),
                        F.when(p["negative"], -factor).otherwise(factor).alias("times"))

    def padded(d: Column) -> Column:
        count = F.ceil(F.length(d["all"]) / WIDTH).cast("int")
        return F.struct(F.lpad(d["all"], count * WIDTH, F.lit("0")).alias("all"), count.alias("count"), d["lowest"].alias("lowest"),
                        d["times"].alias("times"))

    def cut(d: Column) -> Column:
        return F.filter(F.transform(F.sequence(F.lit(1), d["count"]), lambda j: F.struct(
            (d["lowest"] + j - 1).cast("int").alias("place"),
            (F.substring(d["all"], (d["count"] - j) * WIDTH + 1, F.lit(WIDTH)).cast("long") * d["times"])
            .cast("decimal(38,0)").alias("value"))), lambda limb: limb["value"] != 0)

    def found(given: Column) -> Column:
        known = _let(F.btrim(given, F.lit(_SPACE)), lambda plain: _let(halves(plain), lambda h: _let(
            parts(h), lambda p: _let(digits(p), lambda d: _let(padded(d), cut)))))
        return F.when(is_number(given), known)
    # the text is bound once: a checked text would be checked anew wherever it is named
    return _let(text, found).cast(LIMBS)


def from_limbs(found: Column) -> Column:
    """The number of some limbs, one a place at most, as text; null for null."""
    zero, base = F.lit(0).cast("decimal(38,0)"), F.lit(_BASE).cast("decimal(38,0)")

    def ready(got: Column) -> Column:
        places = F.transform(got, lambda limb: limb["place"])
        return F.struct(F.map_from_entries(got).alias("at"), F.least(F.coalesce(F.array_min(places), F.lit(0)), F.lit(0)).alias("low"),
                        (F.greatest(F.coalesce(F.array_max(places), F.lit(0)), F.lit(0)) + _CARRIED).alias("high"))

    def settled(r: Column, sign: int) -> Column:
        """Digits from the lowest place up, and what is carried out at the top (-1 below zero)."""
        def add(state: Column, place: Column) -> Column:
            value = F.coalesce(F.try_element_at(r["at"], place) * sign, zero).cast("decimal(38,0)") + state["carry"]
            return _let(value.cast("decimal(38,0)"), lambda v: _let(F.pmod(v, base).cast("decimal(38,0)"), lambda digit: F.struct(
                ((v - digit) / base).cast("decimal(38,0)").alias("carry"),
                F.concat(F.lpad(digit.cast("string"), WIDTH, "0"), state["text"]).alias("text"))))
        return F.aggregate(F.sequence(r["low"], r["high"]), F.struct(zero.alias("carry"), F.lit("").alias("text")), add)

    def shown(r: Column, negative: Column, text: Column) -> Column:
        whole = F.length(text) + r["low"] * WIDTH
        integer = F.regexp_replace(F.substring(text, F.lit(1), whole), "^0+(?=.)", "")
        return _let(F.regexp_replace(F.substring(text, whole + 1, F.length(text)), "0+$", ""), lambda fraction: F.concat(
            F.when(negative, "-").otherwise(""), integer, F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction))))

    def number(r: Column) -> Column:
        return _let(settled(r, 1), lambda plus: _let(
            F.when(plus["carry"] < 0, settled(r, -1)["text"]).otherwise(plus["text"]),
            lambda text: shown(r, plus["carry"] < 0, text)))
    return F.when(found.isNotNull(), _let(found, lambda got: _let(ready(got), number)))


def times(text: Column, factor: int) -> Column:
    """A number as text times a whole factor, exactly."""
    return from_limbs(limbs(text, factor))


def sum_exact(df: DataFrame, keys: Sequence[str], amounts: Mapping[str, Column]) -> DataFrame:
    """Per key the exact sums of some amounts, each given by its limbs. Nulls
    are skipped; a sum of nulls only is null. A key keeps its row."""
    held = F.array(*[F.struct(F.lit(name).alias("name"), limb.alias("limbs")) for name, limb in amounts.items()])
    rows = df.select(*keys, F.explode(held).alias("a")).select(
        *keys, F.col("a.name").alias("name"), F.col("a.limbs").isNotNull().alias("known"),
        F.explode_outer("a.limbs").alias("limb"))
    sums = (rows.groupBy(*keys, "name", F.col("limb.place").alias("place"))
            .agg(F.sum("limb.value").cast("decimal(38,0)").alias("value"), F.max("known").alias("known"))
            .groupBy(*keys, "name").agg(F.max("known").alias("known"), F.collect_list(
                F.when(F.col("place").isNotNull(), F.struct(F.col("place"), F.col("value")))).cast(LIMBS).alias("limbs")))
    out = sums.select(*keys, "name", F.when(F.col("known"), from_limbs(F.col("limbs"))).alias("total"))
    return out.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == name, F.col("total"))).alias(name) for name in amounts])


def sum_products(df: DataFrame, keys: Sequence[str], text: Column, factors: Mapping[str, Column]) -> DataFrame:
    """``sum_exact`` of one number times several whole factors a row: the number
    is read once, its limbs become rows and are multiplied in plain columns.
    A factor of zero makes the amount zero, also of no number."""
    names = {f: f"__f{i}" for i, f in enumerate(factors)}
    held = [*keys, *names.values()]
    read = df.select(*keys, *[factors[f].alias(n) for f, n in names.items()], text.alias("__text"))
    read = read.select(*held, F.when(is_number(F.col("__text")), F.lower(F.btrim("__text", F.lit(_SPACE)))).alias("__text"))
    read = read.select(*held, F.split_part("__text", F.lit("e"), F.lit(1)).alias("__mantissa"),
                       F.nullif(F.split_part("__text", F.lit("e"), F.lit(2)), F.lit("")).cast("int").alias("__exponent"))
    unsigned = F.ltrim("__mantissa", F.lit("+-"))
    read = read.select(*held, F.startswith("__mantissa", F.lit("-")).alias("__negative"), "__exponent",
                       F.split_part(unsigned, F.lit("."), F.lit(1)).alias("__whole"),
                       F.split_part(unsigned, F.lit("."), F.lit(2)).alias("__fraction"))
    read = read.select("*", (F.length("__fraction") - F.coalesce("__exponent", F.lit(0))).alias("__scale"))
    read = read.select("*", F.pmod(-F.col("__scale"), F.lit(WIDTH)).alias("__spare"))
    read = read.select(*held, "__negative", F.concat("__whole", "__fraction", F.repeat(F.lit("0"), F.col("__spare"))).alias("__all"),
                       (-((F.col("__scale") + F.col("__spare")) / WIDTH)).cast("int").alias("__lowest"))
    read = read.select("*", F.ceil(F.length("__all") / WIDTH).cast("int").alias("__count"))
    read = read.select(*held, "__negative", F.lpad("__all", F.col("__count") * WIDTH, F.lit("0")).alias("__all"), "__lowest", "__count")
    cut = read.select("*", F.explode_outer(F.sequence(F.lit(1), F.col("__count"))).alias("__j"))
    value = F.substring("__all", (F.col("__count") - F.col("__j")) * WIDTH + 1, F.lit(WIDTH)).cast("long")
    cut = cut.select(*held, (F.col("__lowest") + F.col("__j") - 1).alias("__place"), F.col("__j").alias("__j"),
                     (value * F.when(F.col("__negative"), -1).otherwise(1)).alias("__value"))
    # a limb of zero adds nothing; one row of every number stays for its key
    some = F.col("__value") != 0
    cut = cut.where("__value != 0 OR __j = 1 OR __j IS NULL").select(
        *held, F.when(some, F.col("__place")).alias("__place"), "__value")
    zero = {f: F.col(n) == 0 for f, n in names.items()}
    sums = cut.groupBy(*keys, "__place").agg(
        *[F.sum(F.when(some & ~zero[f], (F.col("__value") * F.col(n)).cast("decimal(38,0)"))).cast("decimal(38,0)").alias(n)
          for f, n in names.items()],
        *[F.max(zero[f] | F.col("__value").isNotNull()).alias(f"{n}_known") for f, n in names.items()])
    found = sums.groupBy(*keys).agg(*[a for n in names.values() for a in (
        F.max(f"{n}_known").alias(f"{n}_known"),
        F.collect_list(F.when(F.col("__place").isNotNull() & F.col(n).isNotNull(),
                              F.struct(F.col("__place").alias("place"), F.col(n).alias("value")))).cast(LIMBS).alias(n))])
    return found.select(*keys, *[F.when(F.col(f"{n}_known"), from_limbs(F.col(n))).alias(f) for f, n in names.items()])
