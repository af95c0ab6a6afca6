"""Design invariants checked on the physical plans of all registered queries:
no Python evaluation in the plans and no cartesian / nested-loop joins."""

import re

import __spark_entry__ as E
from conftest import SF_SMALL

FORBIDDEN = r"(BatchEvalPython|ArrowEvalPython|CartesianProduct|BroadcastNestedLoopJoin)"


def test_no_python_or_cartesian_in_plans(spark):
    bad = {}
    for name, fn in E.queries().items():
        if re.match(r"op\d+_|pipeline$", name):
            continue  # the training-data operators run Python where their method asks for it
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        hits = re.findall(FORBIDDEN, plan)
        if hits:
            bad[name] = sorted(set(hits))
    assert not bad, bad
