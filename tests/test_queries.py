"""Every named query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from brindle import registry
from tests.compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    assert name in registry.SQL
    assert differences(spark, con, name, FOLDER) is None


def test_twins_belong_to_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
