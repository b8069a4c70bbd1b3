"""Marts by signed deltas, first values by aggregation, outcomes of a hot key."""

import os
import random
import re

import pytest
from conftest import plan_of, retail, rows_of, srt, ts
from pyspark.sql import functions as F

from cdcmart.operators.deltas import mart_rows, signed_sums
from cdcmart.operators.latest import first_per_key, latest_per_key
from cdcmart.operators.materials import material_demand
from cdcmart.operators.merge import classify_changes, merge_outcomes
from cdcmart.plans.jobs import run_material_delta
from cdcmart.schemas import DEMAND_SCHEMA, RETAIL_COLUMNS
from cdcmart.sources.mart_state import load_delta, read_state, start_state

T0, T1 = ts("2024-01-01 08:00"), ts("2024-01-02 08:00")
DATES = [ts("2024-01-05"), ts("2024-01-31 23:00"), ts("2024-02-01"), ts("2024-03-09"), None]


def demand(rng, n):
    return [(rng.choice(["A", "B", None]), rng.choice(DATES), rng.choice(["cheap", "medium", "expensive", "odd", None]),
             rng.choice(["1", "2.5", "0", "-3", "0.0001", None])) for _ in range(n)]


@pytest.mark.parametrize("recipe", ["sql", "frame"])
def test_history_equals_recomputation(spark, tmp_path, recipe):
    rng, path = random.Random(recipe), str(tmp_path / "state")
    start_state(spark, path)
    held = []
    for batch in range(4):
        gone = rng.sample(held, len(held) // 2) if batch < 3 else list(held)  # at last everything goes
        come = demand(rng, 12) if batch < 3 else []
        for row in gone:
            held.remove(row)
        held += come
        got = run_material_delta(spark, path, spark.createDataFrame(gone, DEMAND_SCHEMA),
                                 spark.createDataFrame(come, DEMAND_SCHEMA), f"b{batch}", recipe)
        want = material_demand(spark.createDataFrame(held, DEMAND_SCHEMA), recipe=recipe)
        assert rows_of(got, *want.columns) == rows_of(want)
    assert held == [] and got.count() == 0


def test_equal_rows_cancel_and_only_touched_months_are_written(spark, tmp_path):
    path = str(tmp_path / "state")
    start_state(spark, path)
    rows = [("A", d, "cheap", "2") for d in DATES] + [("B", DATES[0], "medium", None)]
    load_delta(spark, path, signed_sums(spark.createDataFrame(rows, DEMAND_SCHEMA)), "one")
    folders = [d for d in sorted(os.listdir(path)) if d.startswith("month=")]
    assert len(folders) == 4  # three months and no date
    before = {d: sorted(os.listdir(os.path.join(path, d))) for d in folders}
    old, new = rows, rows[:2] + [("A", DATES[2], "cheap", "7")] + rows[3:]
    months = load_delta(spark, path, signed_sums(spark.createDataFrame(new, DEMAND_SCHEMA), spark.createDataFrame(old, DEMAND_SCHEMA)), "two")
    assert [str(m) for m in months] == ["2024-02-01"]
    after = {d: sorted(os.listdir(os.path.join(path, d))) for d in folders}
    assert [d for d in folders if before[d] != after[d]] == ["month=2024-02-01"]
    assert load_delta(spark, path, signed_sums(spark.createDataFrame(old, DEMAND_SCHEMA), spark.createDataFrame(old, DEMAND_SCHEMA)), "three") == []
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(read_state(spark, path).where(F.col("month").isin(months)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^\]]*month#", plan)


def test_a_load_cut_short_is_repeated(spark, tmp_path):
    path = str(tmp_path / "state")
    start_state(spark, path)
    rows = spark.createDataFrame([("A", d, "cheap", "2") for d in DATES], DEMAND_SCHEMA)
    delta = signed_sums(rows)
    load_delta(spark, path, delta, "first")
    want = rows_of(material_demand(rows.unionByName(rows)))
    # of the second batch only one month was swapped in before it ended
    load_delta(spark, path, delta.where("date < '2024-02-01'"), "second")
    load_delta(spark, path, delta, "second")
    load_delta(spark, path, delta, "second")
    assert rows_of(mart_rows(read_state(spark, path)), "date", "shop_id", "material_name", "quantity_g") == want


def test_first_values_in_one_partial_aggregate(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, 3, None]), f"i{rng.randrange(4)}", rng.choice([1, 2, None]), rng.choice([T0, T1]),
             rng.choice([T0, T1, None]), rng.choice(["I", "U", None])) for _ in range(80)]
    df = retail(spark, rows + rows[:20])
    others = [c for c in RETAIL_COLUMNS if c not in ("id", "last_updated")]
    got = first_per_key(df)
    assert rows_of(got, *RETAIL_COLUMNS) == rows_of(latest_per_key(df, tie_break=others), *RETAIL_COLUMNS)
    plan = plan_of(first_per_key(df))
    assert "partial_max" in plan and "Window" not in plan and plan.count("Exchange hashpartitioning") <= 1
    some = first_per_key(df, columns=["invoice", "quantity"], tie_break="quantity")
    assert some.columns == ["id", "invoice", "quantity"] and some.count() == 4
    assert first_per_key(df.where("false")).count() == 0


def test_a_hot_key_meets_the_join_once(spark):
    target = retail(spark, [(1, f"T{i}", i, T0, T0, None) for i in range(300)] + [(i, "x", 1, T0, T0, None) for i in range(2, 300)]
                    + [(None, "n", 1, T0, T0, None)])
    changes = retail(spark, [(1, "u", 0, T1, T1, "U"), (2, "d", 0, T1, T1, "D"), (3, "i", 0, T1, T1, "I"), (900, "i", 0, T1, T1, "I"),
                             (901, "u", 0, T1, T1, "U"), (None, "n", 0, T1, T1, "D"), (4, "x", 0, T1, T1, None)])
    got = dict((r["outcome"], r["n"]) for r in merge_outcomes(target, changes).collect())
    assert got == {"update": 300, "delete": 1, "matched_noop": 2, "insert": 1, "unmatched_ignored": 2, "untouched": 296}
    for df in (merge_outcomes(target, changes), classify_changes(target, changes)):
        lines = plan_of(df).split("\n")
        # below every join the target is a counted relation: its partial count stands under the exchange
        assert sum("partial_count" in line for line in lines) >= 1
    assert srt((r["id"], r["target_rows"]) for r in classify_changes(target, changes).collect() if r["id"] == 1) == [(1, 300)]
