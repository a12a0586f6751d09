"""Plan-level guard: no registered batch query may contain a cartesian
product, a nested-loop join or Python evaluation, and a single-partition
exchange may only carry aggregated rows (the partial results of a global
aggregate, or a per-bucket side table), never raw rows."""

import pytest

import tidemark.suite  # noqa: F401
from tidemark.registry import REGISTRY

SF = "/root/testdata/sf0.001"
LAZY = ("market", "warehouse", "insights", "serving", "wire", "reports")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
NAMES = sorted(n for n, s in REGISTRY.items() if s.build.__module__.split(".")[-1] in LAZY)


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_forbidden_operator(spark, name):
    plan = REGISTRY[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, f"{name}: {bad}"
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next((x for x in lines[i + 1:] if x.strip(" :+-")
                          and not x.strip(" :+-*()0123456789").startswith(("Project", "Filter"))), "")
            assert "Aggregate" in below, f"{name}: raw rows into one partition: {below.strip()[:120]}"
