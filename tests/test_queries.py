"""Every registered query against its SQL twin, or for rows where it has none."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    verdict = compare(spark, duck, DIR, entry.queries()[name], entry.oracle_sql().get(name))
    assert verdict.startswith(("ok", "rows")), verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0
