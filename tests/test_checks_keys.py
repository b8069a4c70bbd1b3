"""Column checks, key and length constraints."""

import pytest
from conftest import retail, rows_of, ts

from cdcmart.operators.checks import ObservedChecks, column_checks, require_checks
from cdcmart.operators.keys import ConstraintViolation, key_violations, length_violations, require_key
from cdcmart.schemas import RETAIL_CHECKS, RETAIL_LENGTHS, RETAIL_SCHEMA

T0 = ts("2024-01-01 00:00")


def report(df, mapping=RETAIL_CHECKS, **kw):
    return {(r["column"], r["check"], r["comparator"]): (r["actual"], r["passed"])
            for r in column_checks(df, mapping, **kw).collect()}


def test_retail_checks_pass_and_fail(spark):
    good = retail(spark, [(1, "a", -1012, T0, T0, None), (2, "b", 5, T0, T0, None)])
    assert all(p for _, p in report(good).values())
    bad = retail(spark, [(1, "a", -1013, T0, T0, None), (None, "b", None, T0, T0, None)])
    r = report(bad)
    assert r[("quantity", "min", "geq_to")] == (-1013.0, False)
    assert r[("id", "null_check", "equal_to")] == (1.0, False)
    assert r[("quantity", "null_check", "equal_to")] == (1.0, False)
    with pytest.raises(ConstraintViolation):
        require_checks(column_checks(bad, RETAIL_CHECKS))


def test_tolerance_widens_bound(spark):
    df = retail(spark, [(i, "a", 10, T0, T0, None) for i in range(1, 12)])  # 11 rows
    m = {"id": {"distinct_check": {"equal_to": 10, "tolerance": 0.1}},
         "quantity": {"max": {"leq_to": 9, "tolerance": 0.1}, "min": {"greater_than": 11, "tolerance": 0.1}}}
    r = report(df, m)
    assert r[("id", "distinct_check", "equal_to")] == (11.0, True)      # 11 within 10 +- 1
    assert r[("quantity", "max", "leq_to")] == (10.0, False)            # 10 > 9 + 0.9
    assert r[("quantity", "min", "greater_than")] == (10.0, True)       # 10 > 11 - 1.1
    edge = {"quantity": {"max": {"leq_to": 9.0909, "tolerance": 0.1}}}  # 9.0909*1.1 < 10
    assert report(df, edge)[("quantity", "max", "leq_to")][1] is False


def test_accept_none_on_empty_table(spark):
    empty = spark.createDataFrame([], RETAIL_SCHEMA)
    assert report(empty, accept_none=True)[("quantity", "min", "geq_to")] == (0.0, True)
    actual, passed = report(empty, accept_none=False)[("quantity", "min", "geq_to")]
    assert actual is None and passed is False


def test_where_filters_checked_rows(spark):
    df = retail(spark, [(1, "a", -2000, T0, T0, "D"), (2, "b", 5, T0, T0, "I")])
    assert report(df, where="operation = 'I'")[("quantity", "min", "geq_to")] == (5.0, True)


def test_observed_checks_equal_aggregated(spark, tmp_path):
    df = retail(spark, [(1, "a", -1013, T0, T0, None), (None, "b", 3, T0, T0, None), (3, "c", 3, T0, T0, None)])
    mapping = dict(RETAIL_CHECKS)
    mapping["invoice"] = {"unique_check": {"equal_to": 0}}
    obs = ObservedChecks(df, mapping)
    obs.df.write.parquet(str(tmp_path / "out"))
    assert rows_of(obs.report()) == rows_of(column_checks(df, mapping))
    failed = {(c, k) for c, k, *_ in obs.failures()}
    assert failed == {("id", "null_check"), ("quantity", "min")}


def test_key_violations_duplicates_and_nulls(spark):
    df = retail(spark, [(1, "a", 1, T0, T0, None), (1, "b", 1, T0, T0, None), (2, "c", 1, T0, T0, None),
                        (None, "d", 1, T0, T0, None)])
    assert rows_of(key_violations(df, ["id"])) == [(1, 2, "duplicate"), (None, 1, "null_key")]
    assert rows_of(key_violations(df, ["id"], allow_null=True)) == [(1, 2, "duplicate")]
    assert rows_of(key_violations(df, ["id", "invoice"])) == [(None, "d", 1, "null_key")]
    with pytest.raises(ConstraintViolation):
        require_key(df, ["id"])
    require_key(df.where("id = 2"), ["id"])


def test_length_violations(spark):
    df = retail(spark, [(1, "x" * 101, 1, T0, T0, "UU"), (2, "y" * 100, 1, T0, T0, "U")])
    got = {r["column"]: (r["max_length"], r["violations"]) for r in length_violations(df, RETAIL_LENGTHS).collect()}
    assert got["invoice"] == (101, 1)
    assert got["operation"] == (2, 1)
    assert got["country"] == (2, 0)
