"""Every registered query against its SQL on the given tables."""

from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLE)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["window_end_ms", "h3_cell", "driver_count"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == ""
