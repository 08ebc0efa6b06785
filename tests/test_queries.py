"""Every named query against DuckDB on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver tables are not here")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_agrees_with_sql(spark, connection, name):
    same, note, _ = compare(spark, connection, name, SF_DIR)
    assert same, note


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_no_unknown_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
