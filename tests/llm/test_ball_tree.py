"""Operator 6 against all inner products."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingspark.llm import ball_tree

SCHEMA = "vec_id long, embedding array<float>, label int, shard int"


def plain(rows, k=5):
    clean = [
        (i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    asks = {}
    for i, v in sorted(clean):
        if i % 50 == 0:
            asks.setdefault(i, v)
    out = set()
    for q, v in asks.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in clean if j != q and len(w) == len(v))
        out |= {(q, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])}
    return out


def result(frame, **options):
    got = ball_tree.top_k(ball_tree.scaled(frame), F.col("vec_id") % 50 == 0, **options).collect()
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got}


@pytest.mark.parametrize("shard_rows", [60, 100_000])
def test_all_products(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(ball_tree, "BLOCK_QUERIES", 3)
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + draw.normal(size=8) * 0.1).round(1).tolist(), 0, 1) for i in range(700)]
    rows += [(1000 + i, rows[0][1], 0, 1) for i in range(150)]  # a hot vector, so ties
    rows += [(2001, None, 0, 1), (2002, [None] * 8, 0, 1), (2050, [float("nan")] + [0.0] * 7, 0, 1), (2051, [float("inf")] * 8, 0, 1)]
    rows += [(2100, [1.0, 2.0], 0, 1), (2101, [3.0, 4.0], 0, 1), (50, rows[50][1], 0, 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(frame, shard_rows=shard_rows) == plain(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(-(2**20) + 3 * i)], 0, 1) for i in range(120)]
    assert result(spark.createDataFrame(rows, SCHEMA), shard_rows=40) == plain(rows)


def test_few_rows(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == set()
    assert result(spark.createDataFrame([(0, [1.0], 0, 1)], SCHEMA)) == set()
    rows = [(0, [1.0], 0, 1), (7, [-0.5], 0, 1)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == {(0, 1, 7, 256 * -128)}


def test_bounds_prune():
    draw = np.random.default_rng(2)
    rows = np.concatenate([draw.integers(-3, 4, (500, 6)) + 100 * c for c in draw.integers(-9, 10, (8, 6))])
    tree = ball_tree.build(rows, np.arange(len(rows)))
    reads = []
    kept = tree.levels[-1]

    class Spy(list):
        def __getitem__(self, i):
            reads.append(int(i))
            return kept[i]

    tree.levels[-1] = Spy(kept)
    ball_tree.search(tree, rows[:1], np.array([0]), np.array([-np.inf]), 5)
    assert len(reads) < len(kept) / 2
