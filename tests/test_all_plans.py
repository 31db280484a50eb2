"""Every query of the spending chain: no cartesian / nested-loop join, no Python UDF."""

import __spark_entry__ as E
from ledgerlake.plans.registry import JOBS

SF_SMALL = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def test_no_forbidden_operators(spark):
    bad = {}
    for key in JOBS:
        q = E.queries()[key]
        plan = q(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[key] = hits
    assert bad == {}
