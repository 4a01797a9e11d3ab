"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    problem = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert problem in ("", "both empty"), problem


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - {"select_model"}))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["hour", "total", "fakes", "avg_confidence", "fake_pct"] and df.count() > 0
