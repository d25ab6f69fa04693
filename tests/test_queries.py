"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from check import compare
from millrace.plans.queries import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    good, text = compare(spark, SF, name)
    assert good, text


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
