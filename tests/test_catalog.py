"""Every registered query runs and, where it has SQL, gives the same whole result."""

import importlib
import os
import sys

import pytest

from ticketmill.catalog import ORACLES, QUERIES
from ticketmill.catalog.check import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert compare(spark, con, SF, QUERIES[name], ORACLES[name]) == ""
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_entry_points(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(QUERIES)
    assert entry.entry(spark).count() == 8
