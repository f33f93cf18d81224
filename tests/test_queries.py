"""Every registered query against its SQL, and what its plan must not contain."""

import re

import pytest
from compare import connect, difference

import __spark_entry__ as entry

QUERIES, ORACLES = entry.QUERIES, entry.ORACLES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|PythonRDD", plan)
    assert "Window" not in plan
    if "generation" not in name and "attempt_status" not in name:
        assert "InPandas" not in plan and "ArrowEvalPython" not in plan
    assert difference(df, db, ORACLES[name]) is None


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.total == row.written + row.skipped + row.failed > 0
    assert row.band in ("none", "too_few", "ready")
