"""Recipes and the material marts."""

import decimal

import pytest
from conftest import SF_SMALL, rows_of, srt, ts
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cdcmart.functions.recipes import demand_rejects, expand_materials
from cdcmart.operators.materials import material_demand, ordered
from cdcmart.plans import fixtures as fx
from cdcmart.schemas import DEMAND_SCHEMA

DAY = ts("2024-01-01 00:00")

# Expected grams per unit (hand-written, tier -> local, foreign, robusta).
SQL_RECIPE = {"cheap": (20, 0, 0), "medium": (10, 10, 0), "expensive": (0, 10, 10),
              "LARGE": (0, 10, 10), None: (0, 10, 10)}
FRAME_RECIPE = {"cheap": (20, 0, 0), "medium": (10, 10, 0), "expensive": (0, 10, 10),
                "LARGE": (10, 0, 10), None: (10, 0, 10)}


def demand_rows(spark, rows):
    return spark.createDataFrame(rows, DEMAND_SCHEMA)


@pytest.mark.parametrize("recipe,table", [("sql", SQL_RECIPE), ("frame", FRAME_RECIPE)])
def test_recipe_table(spark, recipe, table):
    df = demand_rows(spark, [("S1", DAY, tier, "2") for tier in table])
    got = {r["product_name"]: (float(r["local_arabica"]), float(r["foreign_arabica"]), float(r["robusta"]))
           for r in expand_materials(df, recipe).collect()}
    assert got == {t: tuple(2.0 * v for v in vals) for t, vals in table.items()}


def test_null_demand_gives_null_except_literal_zero(spark):
    df = demand_rows(spark, [("S1", DAY, "cheap", None)])
    r = expand_materials(df, "sql").first()
    assert (r["local_arabica"], r["foreign_arabica"], r["robusta"]) == (None, 0, 0)


def test_bad_demand_text_strict_and_lenient(spark):
    df = demand_rows(spark, [("S1", DAY, "cheap", "ten"), ("S1", DAY, "cheap", "3")])
    with pytest.raises(PySparkException):
        expand_materials(df, "sql", strict=True).collect()
    lenient = rows_of(expand_materials(df, "sql", strict=False), "demand", "local_arabica")
    assert lenient == [("3", decimal.Decimal("60.0000")), ("ten", None)]
    assert rows_of(demand_rejects(df), "demand") == [("ten",)]


def test_grams_mart_keeps_null_shop_and_zero_rows(spark):
    df = demand_rows(spark, [("S1", DAY, "cheap", "1"), ("S1", DAY, "cheap", "2"), (None, DAY, "medium", "1"),
                             ("S2", DAY, "cheap", None)])
    got = rows_of(material_demand(df, unit="g").withColumn("quantity_g", F.col("quantity_g").cast("double")),
                  "shop_id", "material_name", "quantity_g")
    assert got == srt([
        ("S1", "local_arabica", 60.0), ("S1", "foreign_arabica", 0.0), ("S1", "robusta", 0.0),
        (None, "local_arabica", 10.0), (None, "foreign_arabica", 10.0), (None, "robusta", 0.0),
        ("S2", "local_arabica", None), ("S2", "foreign_arabica", 0.0), ("S2", "robusta", 0.0)])


def test_kg_mart_drops_null_keys_and_sums_to_zero(spark):
    df = demand_rows(spark, [("S1", DAY, "cheap", "100"), (None, DAY, "medium", "1"),
                             ("S2", DAY, "expensive", None), ("S3", None, "cheap", "1")])
    out = material_demand(df, unit="kg")
    assert dict(out.dtypes)["date"] == "date"
    got = rows_of(out.withColumn("demand_kg", F.col("demand_kg").cast("double")),
                  "shop_id", "raw_material", "demand_kg")
    assert got == srt([("S1", "local_arabica", 2.0), ("S1", "foreign_arabica", 0.0), ("S1", "robusta", 0.0),
                       ("S2", "local_arabica", 0.0), ("S2", "foreign_arabica", 0.0), ("S2", "robusta", 0.0)])


def test_grams_total_is_twenty_per_unit_for_sql_recipe(spark):
    demand = fx.demand(spark, SF_SMALL)
    total = material_demand(demand, unit="g").agg(F.sum("quantity_g")).first()[0]
    units = demand.agg(F.sum(F.col("demand").cast("decimal(18,4)"))).first()[0]
    assert total == units * 20


def test_grain_day_and_text_and_order(spark):
    df = demand_rows(spark, [("S1", ts("2024-01-01 08:00"), "cheap", "1"), ("S1", ts("2024-01-01 09:00"), "cheap", "1")])
    assert material_demand(df, unit="g").count() == 6
    assert material_demand(df, unit="g", grain="day").count() == 3
    text = material_demand(df, unit="g", grain="day", as_text=True)
    assert dict(text.dtypes)["quantity_g"] == "string"
    assert {r["quantity_g"] for r in text.collect()} == {"40.0000", "0.0000"}
    kg = ordered(material_demand(df, unit="kg", grain="day"))
    assert [r["raw_material"] for r in kg.collect()] == ["local_arabica", "foreign_arabica", "robusta"]
