"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from tools.compare import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    error, rows, _ = compare(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert error is None and rows > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
