"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck_tables

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    return duck_tables(SF_DIR)


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert "past_3_hours_delay" in frame.columns


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, tables, name):
    frame = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        problems, rows = compare(frame, tables, sql)
        assert not problems
        assert rows > 0
