"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.run import compare, reference

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return reference(SF)


# empty on so few rows: no two postings alike, no day or state in the window
MAY_BE_EMPTY = {"near_duplicates", "near_duplicate_members", "latest_jobs", "qcew_trend"}


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    ok, text = compare(spark, con, SF, name)
    assert ok or (name in MAY_BE_EMPTY and text.startswith("0 rows")), text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
