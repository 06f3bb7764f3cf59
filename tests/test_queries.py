"""Every registered query against its SQL at the smallest scale; ``check_queries.py`` does the same at larger ones."""

from __future__ import annotations

import pytest
from check_queries import compare, open_tables

import __spark_entry__ as entry
from cohortloom.plans.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return open_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[:3] == ["source_study", "diagnosis", "samples"] and frame.count() > 0
