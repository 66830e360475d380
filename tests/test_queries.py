"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from compare import difference

import __spark_entry__ as entry
from feedloom.queries import REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, name):
    assert difference(entry.queries()[name](spark, SF), SF, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["日付", "広告名", "クリック数"] and frame.count() > 0
