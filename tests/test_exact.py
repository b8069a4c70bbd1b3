"""Numbers of any size and scale, and rejects in the same pass."""

import random
from decimal import Decimal, getcontext

import pytest
from conftest import plan_of, ts
from pyspark.sql import functions as F

from cdcmart.functions.exact import from_limbs, is_number, limbs, sum_exact, sum_products, times
from cdcmart.functions.recipes import MATERIALS, split_rejects
from cdcmart.operators.materials import exact_material_demand, material_demand
from cdcmart.schemas import DEMAND_SCHEMA

getcontext().prec = 400


def plain(value):
    text = format(value, "f")
    if "." in text:
        text = text.rstrip("0").rstrip(".")
    return "0" if text in ("-0", "") else text


def numbers():
    rng = random.Random(8)
    out = ["0", "-0", "0.0", "1", "-1", "0.00004", ".5", "5.", "+7", " 12 ", "1e3", "1E-3", "-2.5e+2", "1e60", "3e-60", "999999999", "1000000000",
           "-999999999.999999999", "9" * 60, "-" + "9" * 60 + "." + "9" * 60, "0" * 30 + "1"]
    for _ in range(60):
        out.append(rng.choice(["", "-"]) + "".join(rng.choices("0123456789", k=rng.randint(1, 60)))
                   + rng.choice(["", "." + "".join(rng.choices("0123456789", k=rng.randint(1, 40)))]) + rng.choice(["", "", "e-7", "e12"]))
    return out


def test_round_trip_and_products(spark):
    texts = numbers()
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", from_limbs(limbs(F.col("t"))).alias("same"), times(F.col("t"), 20).alias("twenty")).collect()
    for r in got:
        assert r["same"] == plain(Decimal(r["t"])), r["t"]
        assert r["twenty"] == plain(Decimal(r["t"]) * 20), r["t"]


def test_sums(spark):
    rng = random.Random(9)
    rows = [(k, rng.choice(numbers())) for k in range(8) for _ in range(40)] + [(50, None), (51, None), (51, "2"), (52, "1"), (52, "-1")]
    got = {r["k"]: r["s"] for r in sum_exact(spark.createDataFrame(rows, "k int, t string"), ["k"], {"s": limbs(F.col("t"))}).collect()}
    for k in {k for k, _ in rows}:
        held = [Decimal(t) for j, t in rows if j == k and t is not None]
        assert got[k] == (plain(sum(held)) if held else None), k


def test_other_text_is_no_number(spark):
    bad = ["", " ", "abc", "1,5", "1.2.3", "--1", "e5", ".", "-", "+.", "1e", "0x1", "1 2", "NaN", ".e3"]
    df = spark.createDataFrame([(t,) for t in bad], "t string")
    assert df.where(is_number(F.col("t"))).count() == 0
    assert df.where(limbs(F.col("t")).isNotNull()).count() == 0


def test_marts(spark):
    d = ts("2024-01-01 00:00")
    rows = [("S1", d, "cheap", "0.00004"), ("S1", d, "medium", "9" * 40), (None, d, None, "3"), ("S2", d, "cheap", None)]
    df = spark.createDataFrame(rows, DEMAND_SCHEMA)
    got = {(r["shop_id"], r["material_name"]): r["quantity_g"] for r in exact_material_demand(df).collect()}
    assert got["S1", "local_arabica"] == plain(Decimal("0.0008") + Decimal("9" * 40) * 10)
    assert got[None, "robusta"] == "30" and got["S2", "local_arabica"] is None and got["S2", "robusta"] == "0"
    small = spark.createDataFrame([(s, t, p, "2.5") for s, t, p, _ in rows], DEMAND_SCHEMA)
    for unit, value in (("g", "quantity_g"), ("kg", "demand_kg")):
        exact = sorted((r[1] or "", r[2], float(r[value])) for r in exact_material_demand(small, unit).collect())
        assert exact == sorted((r[1] or "", r[2], float(r[value])) for r in material_demand(small, unit).collect())
    with pytest.raises(Exception, match="not a number"):
        exact_material_demand(spark.createDataFrame([("S", d, "cheap", "x")], DEMAND_SCHEMA)).collect()


def test_rejects_in_one_scan(spark, tmp_path):
    df = spark.createDataFrame([(1, "1"), (2, "x"), (3, None), (4, "0.00004"), (5, "")], "id int, demand string")
    good, bad, counts = split_rejects(df, str(tmp_path / "out"))
    assert counts == {"good": 3, "rejected": 2}
    assert sorted(r.id for r in good.collect()) == [1, 3, 4] and sorted(r.id for r in bad.collect()) == [2, 5]
    assert "PartitionFilters" in plan_of(bad) and MATERIALS


def test_sums_of_products_read_each_number_once(spark):
    rng = random.Random(10)
    rows = [(k, rng.choice(numbers()), rng.choice([0, 20, 10])) for k in range(8) for _ in range(40)]
    rows += [(50, None, 10), (51, None, 0), (52, "x", 10), (53, "1", 10), (53, "-1", 10), (54, "x", 0)]
    df = spark.createDataFrame(rows, "k int, t string, f int")
    out = sum_products(df, ["k"], F.col("t"), {"a": F.col("f"), "b": F.lit(3)})
    plan = plan_of(out)
    assert plan[plan.index("Generate"):].count("RLIKE") == 1 and "transform(" not in plan[plan.index("Generate"):]
    got = {r["k"]: (r["a"], r["b"]) for r in out.collect()}
    limit = {k: limbs_sum for k, limbs_sum in ((r["k"], (r["a"], r["b"])) for r in sum_exact(df, ["k"], {
        "a": F.when(F.col("f") == 0, limbs(F.lit("0"))).when(F.col("f") == 20, limbs(F.col("t"), 20)).otherwise(limbs(F.col("t"), 10)),
        "b": limbs(F.col("t"), 3)}).collect())}
    assert got == limit and got[50] == (None, None) and got[51] == ("0", None) and got[53] == ("0", "0")
    for k in range(8):
        held = [(Decimal(t), f) for j, t, f in rows if j == k]
        assert got[k] == (plain(sum(t * f for t, f in held)), plain(sum(t * 3 for t, _ in held))), k
