"""Every registered query against its SQL on the smallest tables."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
import compare
from layerwell.plans.oracle import ORACLE
from layerwell.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert compare.type_families(df, connection, ORACLE[name]) == {}
    assert compare.spark_rows(df) == compare.sql_rows(connection, ORACLE[name])


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
