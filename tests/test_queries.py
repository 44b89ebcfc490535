"""Every registered query against its SQL twin on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["segment", "critical", "high", "medium", "low"] and frame.count() == 4


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    assert difference(got, con.execute(entry.oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0
