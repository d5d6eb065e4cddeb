"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    if name in ORACLES:
        difference, _ = compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR)
        assert difference is None, difference
    else:
        assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
