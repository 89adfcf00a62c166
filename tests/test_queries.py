"""Every registered query against its SQL on the sf0.001 tables (SF_DIR overrides)."""

import os

import pytest

import __spark_entry__ as entry
from checks import QUERIES, SQL
from tests.compare import differences, duck

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = differences(QUERIES[name](spark, SF_DIR), con, SQL[name])
    assert not found, "\n".join(found)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
