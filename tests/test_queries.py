"""Every registered query against its SQL twin."""

import os
import re

import pytest

import __spark_entry__ as registry
from tests.compare import assert_same, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
OWN = [name for name in registry.queries() if not re.match(r"op\d+_|pipeline$", name)]


@pytest.fixture(scope="module")
def oracle():
    return duck(SF_DIR)


def test_every_query_has_a_twin():
    assert set(OWN) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_its_twin(spark, oracle, name):
    actual = registry.queries()[name](spark, SF_DIR)
    plan = actual._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    assert assert_same(actual, oracle, registry.oracle_sql()[name]) > 0


def test_entry(spark):
    gold = registry.entry(spark)
    assert gold.columns == ["pickup_zone", "avg_speed_kmh", "max_speed_kmh"]
    assert gold.count() == 21
