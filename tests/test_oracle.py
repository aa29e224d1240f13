"""Every registered query against DuckDB on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
import check

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    assert check.compare(spark, con, SF_DIR, name) is None


def test_entry_has_rows_and_schema(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["c_custkey", "o_orderkey", "o_orderdate"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
