"""Every registered query against its DuckDB statement on the given tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from candlewick import oracle, registry
from tests.parity import differences, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_each_query_has_a_statement():
    assert set(registry.queries()) == set(oracle.statements())
    assert set(registry.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, connection, name):
    count, problem = differences(contract.queries()[name](spark, SF_DIR), connection, contract.oracle_sql()[name])
    assert not problem
    assert count > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
