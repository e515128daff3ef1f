"""Every registered query equals its SQL (smallest scale)."""

import pytest

import __spark_entry__ as entry
from changeflow import registry
from conftest import SF
from oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF) is None


def test_every_query_has_sql():
    """Those of the main library; what SQL can't express in the training-data operators has tests of its own."""
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "cnt", "window_end"] and df.limit(1).count() == 1
