"""Every query against its SQL at the smallest scale, and what its plan must not contain."""

import pytest
from compare import difference

from tallylake.checks import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = (
    "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
    "BroadcastNestedLoopJoin Inner", "BroadcastNestedLoopJoin Cross",
)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) and len(QUERIES) == 81


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, name):
    plans = []

    def run(session, sf_dir):
        df = QUERIES[name](session, sf_dir)
        plans.append(df)
        return df

    problem, _ = difference(spark, SF, run, ORACLES[name])
    assert problem is None
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
