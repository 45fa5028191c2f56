"""Every registered query against its SQL on the smallest shared tables."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from check import compare, connect

from wardflow.plans.oracle import ORACLE_SQL
from wardflow.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not Path(SF_DIR).exists():
        pytest.skip("shared test tables not present")
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_query_names():
    assert not [n for n in QUERIES if "pipeline" in n or re.match(r"op\d+_", n)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert compare(name, df, con, ORACLE_SQL[name]) == []
