"""Plan-level guards over every registered query: no cross products, no
Python evaluation in the plan (everything stays in JVM expressions)."""

import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("key", sorted(entry._QUERIES))
def test_plan_has_no_cross_product_or_python(spark, key):
    df = entry.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad} in plan"
