"""Queries that SQL can say too."""

import os

import pytest

from tests.compare import assert_same, duck
from tripstrata.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_twin(spark, name):
    actual = queries.QUERIES[name](spark, SF_DIR)
    assert assert_same(actual, duck(SF_DIR), queries.ORACLE_SQL[name]) > 0
