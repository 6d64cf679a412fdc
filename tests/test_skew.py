"""Queries with the salting of hot keys switched on by a low limit, against their SQL twins."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from filingspark.operators import keys as K
from tests.compare import compare, connect

DIR = "/root/testdata/sf0.001"
JOINED = [
    "known_companies", "screener_enrich", "company_dossier", "triples_resolved", "news_price_labels",
    "volume_trend", "feature_table", "incremental_fresh", "batch_skip", "mentions", "similar_pairs",
    "similarity_groups",
]


@pytest.fixture(scope="module")
def duck():
    return connect(DIR)


@pytest.mark.parametrize("name", JOINED)
def test_salted(spark, duck, monkeypatch, name):
    monkeypatch.setattr(K, "ROWS_PER_TASK", 3)
    verdict = compare(spark, duck, DIR, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def test_salting_is_on(spark, monkeypatch):
    monkeypatch.setattr(K, "ROWS_PER_TASK", 3)
    big = spark.range(30).selectExpr("id", "1 AS k")
    small = spark.createDataFrame([(1, "x")], "k int, v string")
    joined = K.spread_join(big, small, ["k"], spread_on=["id"])
    assert joined.count() == 30
