"""Every registered key against its DuckDB oracle at sf0.001 (the driver's check, smaller)."""

import pytest

from edgeframe.plans.inspect import plan_text
from edgeframe.plans.registry import ORACLES, QUERIES
from tests.conftest import SF001
from tools.oracle_check import compare, duck

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", KEYS)
def test_key_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    plan = plan_text(df)
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    sql = ORACLES.get(name)
    if sql is None:
        assert df.count() >= 0
        return
    problems, _, _ = compare(df, con, sql)
    assert not problems, problems


def test_every_key_has_oracle():
    from __spark_entry__ import oracle_sql, queries
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert len(rows) == 1 and rows[0]["closed_paths"] >= 0
