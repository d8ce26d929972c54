"""Plan guards over every registered query: no cross join and no nested-loop join."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_no_cartesian_products(spark):
    bad = {}
    for name, fn in E.queries().items():
        if name in E.CORPUS:            # those run jobs while they are built; see tests/llm
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        if "CartesianProduct" in plan:
            bad[name] = "CartesianProduct"
        elif "BroadcastNestedLoopJoin" in plan:
            bad[name] = "BroadcastNestedLoopJoin"
    assert bad == {}
