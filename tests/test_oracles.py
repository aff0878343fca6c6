"""Every registered query against its SQL.

The SQL of the extraction flows takes every article for the container, which
holds for this size (all articles reach 50 characters).
"""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
from webwinnow.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    message, same = compare(spark, con, name, SF_DIR)
    assert same, message


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 50
