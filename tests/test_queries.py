"""Every registered query against its SQL on DuckDB."""

import os

import compare
import pytest

import __spark_entry__ as entry_module
from barspan.plans.oracles import oracle_sql
from barspan.plans.queries import QUERIES

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert compare.differences(df, con, oracle_sql()[name]) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
