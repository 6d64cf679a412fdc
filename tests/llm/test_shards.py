"""Operator 10: near equal bytes, gapless slots, hot keys cut apart."""

from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from filingspark.llm import shards
from filingspark.llm.tables import place, weighted_splitters
from tests.llm import docs


def _check(got, count):
    slots, weight = defaultdict(list), defaultdict(int)
    for r in got:
        assert 0 <= r["shard"] < count
        slots[r["shard"]].append(r["slot"])
        weight[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return weight


def test_documents(spark):
    rows = docs.corpus()
    frame = docs.documents(spark, rows).selectExpr("*", "9 as shard", "8 as slot", "7 as _k1")
    got = shards.shard_documents(frame, 4).collect()
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    weight = _check(got, 4)
    total = sum(weight.values())
    longest = max(r["size"] for r in got)
    assert all(abs(w - total / 4) <= longest for w in weight.values())
    for r in got:
        text = (rows[r["doc_id"]][1] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 8, zlib.crc32(text), "bytes", None)
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in shards.shard_documents(frame.repartition(5), 4).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in got}


def test_hot_key_is_cut(spark):
    rows = [(i, "the same" if i % 3 else f"other {i}", None, None, 0) for i in range(6000)]
    got = shards.shard_documents(docs.documents(spark, rows), 24).collect()
    weight = _check(got, 24)
    assert max(weight.values()) - min(weight.values()) <= 64
    same = [r["shard"] for r in got if r["doc_id"] % 3]
    assert max(same) - min(same) + 1 == len(set(same)) > 12  # one stretch


def test_few_rows(spark):
    assert shards.shard_documents(docs.documents(spark, []), 24).count() == 0
    got = shards.shard_documents(docs.documents(spark, [(1, None, None, None, 0)] * 3), 24).collect()
    assert len(_check(got, 24)) == 3


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(shards, "SAMPLES_PER_RANGE", 1)
    frame = spark.range(5000).select(
        F.xxhash64("id").alias("_k1"), F.lit(1).cast("long").alias("_k2"), F.lit(10).cast("long").alias("_size")
    )
    _, held = shards.splitters(frame, 50)
    assert sum(r["n"] for r in held) == 5000
    assert max(r["bytes"] for r in held) <= 2.5 * 50_000 / 50


@pytest.mark.parametrize("count", [0, 1, 2, 10, 101])
def test_place(spark, count):
    bounds = [3 * i for i in range(count)]
    frame = spark.range(-2, 3 * count + 3).select("id", place(F.col("id"), bounds).alias("p"))
    assert all(r["p"] == sum(b <= r["id"] for b in bounds) for r in frame.collect())


def test_weighted_splitters():
    assert weighted_splitters([], 4) == []
    assert weighted_splitters([((i, 0), 1.0) for i in range(8)], 4) == [(2, 0), (4, 0), (6, 0)]


def test_main_path_is_native(spark):
    plan = shards.shard_documents(docs.documents(spark), 3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_write_shards(spark, tmp_path):
    frame = shards.shard(docs.documents(spark), F.col("text"), F.col("doc_id"), F.lit(1), 3)
    shards.write_shards(frame, str(tmp_path / "out"), files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(docs.corpus()) and back.select("shard").distinct().count() == 3
