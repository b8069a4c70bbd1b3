"""Every registered query plans without cross / nested-loop joins and without
Python evaluation."""

import importlib.util
import os

import pytest
from conftest import ROOT, SF_SMALL, plan_of

from cdcmart.plans import catalog

spec = importlib.util.spec_from_file_location("spark_entry_plans", os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan_has_no_cross_join_or_python(spark, name):
    plan = plan_of(entry_mod.queries()[name](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in plan], plan
