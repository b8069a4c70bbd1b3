"""Check states kept with a snapshot against the checks over the whole table."""

import random

import pytest
from conftest import rows_of

from cdcmart.operators.check_states import advance_states, check_states, settle_states, state_report
from cdcmart.operators.checks import column_checks

SCHEMA = "month string, price double, quantity int, customer_id string"
CHECKS = {"price": {"min": {"geq_to": 1, "tolerance": 0.5}, "max": {"leq_to": 4}, "null_check": {"leq_to": 3}},
          "quantity": {"min": {"greater_than": 0}}, "customer_id": {"null_check": {"equal_to": 0}}}
PART = "month"


def rows(rng, n):
    return [(rng.choice(["01", "02", "03", None]), rng.choice([1.0, 2.0, 3.0, 4.0, None, float("nan")]),
             rng.choice([1, 2, 3, None]), rng.choice(["a", None])) for _ in range(n)]


def step(spark, path, states, gone, come, table):
    advanced = advance_states(states, spark.createDataFrame(gone, SCHEMA), spark.createDataFrame(come, SCHEMA), CHECKS, PART)
    advanced.write.parquet(path)
    advanced = spark.read.parquet(path)
    return advanced, settle_states(advanced, spark.createDataFrame(table, SCHEMA), CHECKS, PART)


@pytest.mark.parametrize("seed", range(3))
def test_random_history_equals_the_full_pass(spark, tmp_path, seed):
    rng, table = random.Random(seed), []
    states = check_states(spark.createDataFrame(table, SCHEMA), CHECKS, PART)
    for i in range(4):
        gone = rng.sample(table, (2 * len(table)) // 3) if i < 3 else list(table)  # at last everything goes
        come = rows(rng, 8) if i < 3 else []
        for row in gone:
            table.remove(row)
        table += come
        now = spark.createDataFrame(table, SCHEMA)
        _, settled = step(spark, str(tmp_path / f"a{i}"), states, gone, come, table)
        settled.write.parquet(str(tmp_path / f"s{i}"))
        states = spark.read.parquet(str(tmp_path / f"s{i}"))
        assert str(rows_of(states)) == str(rows_of(check_states(now, CHECKS, PART)))
        assert str(rows_of(state_report(states, CHECKS))) == str(rows_of(column_checks(now, CHECKS)))
        assert str(rows_of(state_report(states, CHECKS, False))) == str(rows_of(column_checks(now, CHECKS, accept_none=False))) or not table
    assert states.count() == 0


def test_only_a_part_that_loses_its_last_least_value_is_open(spark, tmp_path):
    table = [("01", 1.0, 5, "a"), ("01", 1.0, 5, "a"), ("01", 2.0, 5, "a"), ("02", 1.0, 5, "a"), ("02", 3.0, 5, "a")]
    states = check_states(spark.createDataFrame(table, SCHEMA), CHECKS, PART)
    # one of two rows with the least price goes: its count falls; a lower price in 02 needs no second look
    advanced, _ = step(spark, str(tmp_path / "a"), states, [table[0], table[3]], [("02", 0.5, 5, "a")],
                       table[1:3] + [table[4], ("02", 0.5, 5, "a")])
    assert advanced.where("open").count() == 0
    got = {(r["part"], r["lo"], r["lo_count"]) for r in advanced.where("column = 'price'").collect()}
    assert got == {("01", 1.0, 1), ("02", 0.5, 1)}
    advanced, settled = step(spark, str(tmp_path / "b"), states, table[:2], [], table[2:])
    assert [(r["part"], r["column"]) for r in advanced.where("open").collect()] == [("01", "price")]
    assert {(r["part"], r["lo"]) for r in settled.where("column = 'price'").collect()} == {("01", 2.0), ("02", 1.0)}


def test_rows_out_and_in_again_cancel(spark):
    table = [("01", 1.0, 5, "a"), (None, None, None, None)]
    df = spark.createDataFrame(table, SCHEMA)
    states = check_states(df, CHECKS, PART)
    advanced = advance_states(states, df, df, CHECKS, PART)
    assert advanced.where("open").count() == 0 and rows_of(advanced.drop("open")) == rows_of(states)


def test_distinct_counts_are_refused(spark):
    with pytest.raises(ValueError, match="cannot be kept"):
        check_states(spark.createDataFrame([], SCHEMA), {"price": {"unique_check": {"equal_to": 0}}}, PART)
