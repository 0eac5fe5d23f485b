"""Every query of the warehouse equals its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
import catalog
import oracles
import verify


@pytest.fixture(scope="module")
def con():
    return verify.duck("/root/testdata/sf0.001")


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracles.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, sf, name):
    same, note = verify.compare(spark, con, name, sf)
    assert same, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
