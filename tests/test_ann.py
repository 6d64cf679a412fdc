"""Hash tables for vectors: recall against the exact search, probes against all buckets."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingspark.operators import ann
from filingspark.operators import similarity as S

DIMENSIONS = 32


def _clustered(count=6000, centres=150, seed=1):
    draw = np.random.default_rng(seed)
    centre = draw.standard_normal((centres, DIMENSIONS))
    return centre[draw.integers(0, centres, count)] + 0.35 * draw.standard_normal((count, DIMENSIONS))


@pytest.fixture(scope="module")
def rows():
    return _clustered()


@pytest.fixture(scope="module")
def vectors(spark, rows):
    data = [(i, v.tolist(), i % 4) for i, v in enumerate(rows)]
    data += [(10_000 + i, rows[7].tolist(), 1) for i in range(300)]  # one bucket with many copies
    data += [(20_001, None, 0), (20_002, [1.0], 0), (20_003, [float("nan")] * DIMENSIONS, 0), (20_004, [None] * DIMENSIONS, 0)]
    return spark.createDataFrame(data, "id long, v array<float>, label int").repartition(5)


@pytest.fixture(scope="module")
def index(spark, vectors, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ann") / "index")
    return ann.build_index(vectors, path, "id", "v", ["label"])


def _hits(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        found.setdefault(r["query"], []).append((r["id"], round(r["score"], 6)))
    return found


def _recall(found, exact):
    """Ties at the last place count as met."""
    met = sum(min(len(e), sum(1 for h in found[q] if h[1] >= e[-1][1])) for q, e in exact.items())
    return met / sum(map(len, exact.values()))


def test_recall_with_few_candidates(spark, vectors, index, rows):
    good = vectors.where("id < 20000")
    queries = {str(i): rows[i].tolist() for i in range(0, 6000, 300)}
    exact = _hits(S.knn(good, "v", queries, 10, "id"))
    found = _hits(ann.knn_lsh(spark, index, queries, 10, 600))
    assert _recall(found, exact) >= 0.9
    assert _recall(_hits(ann.knn_lsh(spark, index, queries, 10, 10)), exact) < _recall(found, exact)


def test_filter(spark, vectors, index, rows):
    queries = {str(i): rows[i].tolist() for i in range(0, 6000, 600)}
    where = F.col("label") == 2
    exact = _hits(S.knn(vectors.where("id < 20000"), "v", queries, 5, "id", where=where))
    found = ann.knn_lsh(spark, index, queries, 5, 400, ["label"], where=where)
    assert {r["label"] for r in found.collect()} == {2}
    assert _recall(_hits(found), exact) >= 0.9


def test_all_candidates_are_exact(spark, vectors, index, rows):
    queries = {"a": rows[7].tolist(), "b": rows[8].tolist()}
    found = _hits(ann.knn_lsh(spark, index, queries, 400, 10**9, most_probes=1 << index.bits))
    assert found == _hits(S.knn(vectors.where("id < 20000"), "v", queries, 400, "id"))
    assert len(found["a"]) == 400


def test_opened_index_reads_few_folders(spark, index, rows):
    same = ann.open_index(spark, index.path)
    assert same == index
    plan = ann.knn_lsh(spark, same, {"a": rows[3].tolist()}, 3, 50)._jdf.queryExecution().executedPlan().toString()
    folders = [line for line in plan.splitlines() if "PartitionFilters" in line and "cell#" in line]
    assert folders and "bucket" in folders[0].split("PushedFilters")[1]


def test_probes_come_in_ascending_cost(index, rows):
    small = ann.Index("", "v", "id", DIMENSIONS, 2, 5, 3, "")
    found = ann.probes(small, rows[0], 32)
    for table, directions in enumerate(small.directions()):
        margin = directions @ (rows[0] / np.linalg.norm(rows[0]))
        price = (margin / np.linalg.norm(directions, axis=1)) ** 2
        own = sum(1 << i for i in range(5) if margin[i] >= 0)
        want = sorted((sum(price[i] for i in range(5) if (b ^ own) >> i & 1), b) for b in range(32))
        mine = [(c, b) for t, b, c in found if t == table]
        assert sorted(b for _, b in mine) == list(range(32))
        assert np.allclose([c for c, _ in mine], [c for c, _ in want])


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "id long, v array<float>, label int")
    index = ann.build_index(none, str(tmp_path / "none"), "id", "v")
    assert ann.knn_lsh(spark, index, {"a": [1.0]}, 3, 10).count() == 0
