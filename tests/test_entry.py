"""The driver contract: entry, queries, oracles (compared on the small tables)."""

import importlib.util
import os

import pytest
from conftest import ROOT, SF_SMALL

from cdcmart.plans import catalog
from oracle import compare, duck

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns[0] == "id" and len(df.columns) == 11
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert "default_dates" in entry_mod.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, con, entry_mod.oracle_sql()[name])
    assert ok, msg
