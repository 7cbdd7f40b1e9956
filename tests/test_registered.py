"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry
from hazlake.plans.checks import QUERIES, SQL
from tests.compare import differences

FOLDER = os.environ.get("HAZLAKE_TESTDATA", "/root/testdata/sf0.001")


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.items() <= entry.queries().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), SQL[name], FOLDER) is None
