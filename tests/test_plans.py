"""Every registered query plans without quadratic joins or Python evaluation."""

import os

import pytest

from labormart.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
def test_no_quadratic_joins_or_python(spark):
    bad = {}
    for name, fn in QUERIES.items():
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[name] = hits
    assert bad == {}
