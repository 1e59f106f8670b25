"""Every check query gives the rows of its reference SQL. CHECK_SF picks the data size."""

import os

import pytest

import __spark_entry__ as entry
from workload.queries import QUERIES
from tests.compare import difference

FOLDER = f"/root/testdata/{os.environ.get('CHECK_SF', 'sf0.001')}"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no check data")


def test_every_query_has_reference_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert difference(spark, FOLDER, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
