"""Expected values recorded in FIXTURES.md §4 (sf0.01) for the unchanged fixture sets."""

from conftest import SF_ORACLE
from pyspark.sql import functions as F

from cdcmart.plans import catalog


def test_merge_o_anchors(spark):
    outcomes = dict((r["outcome"], r["n"]) for r in catalog.merge_outcomes_query(spark, SF_ORACLE).collect())
    assert outcomes == {"delete": 759, "insert": 262, "update": 1491, "matched_noop": 1500,
                        "unmatched_ignored": 988, "untouched": 11250}
    r = catalog.merge_full(spark, SF_ORACLE).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("p"), F.sum("quantity").alias("q")).first()
    assert (r["n"], r["p"], r["q"]) == (14503, 3192687043.45, -476841)


def test_material_anchors(spark):
    g = catalog.material_grams(spark, SF_ORACLE)
    assert g.count() == 159921
    got = {r[0]: r[1] for r in g.groupBy("material_name").agg(F.sum("quantity_g")).collect()}
    assert got == {"local_arabica": 10003490.0, "foreign_arabica": 12884050.0, "robusta": 7595160.0}
    k = catalog.material_kg(spark, SF_ORACLE)
    assert k.count() == 158220
    got = {r[0]: round(r[1] * 1000) for r in k.groupBy("raw_material").agg(F.sum("demand_kg")).collect()}
    assert got == {"local_arabica": 14919720, "foreign_arabica": 7713650, "robusta": 7519490}
