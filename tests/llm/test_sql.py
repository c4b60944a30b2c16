"""Queries that have SQL, against DuckDB on the same tables."""

import os

import compare
import pytest

from barspan.llm import queries

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF_DIR), compare.connect(SF_DIR), queries.SQL[name]) == []
