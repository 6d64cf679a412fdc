"""Operator 8: exact shares, whole words and a schedule of low discrepancy."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from filingspark.llm import mixing
from tests.llm import docs


def water(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if most * sizes[s] <= level * weight[s]}
        if not full:
            return out | {s: level * weight[s] for s in free}
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        free -= full
    return out


def test_taken(spark):
    rows = docs.corpus() * 1
    frame = docs.documents(spark, rows).selectExpr("*", "1 as start", "2 as slot", "3 as size", "4 as target")
    taken, order = mixing.mix(mixing.sized(frame), block=16)
    got = taken.collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(docs.words(text))
    targets = water(sizes)
    per = defaultdict(int)
    for r in got:
        text = rows[r["doc_id"]][1]
        assert r["size"] == len(docs.words(text))
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        per[r["source"]] += r["taken"]
    assert {s: per[s] for s in sizes} == {s: round(t) for s, t in targets.items()}
    drawn = defaultdict(int)
    for r in order.collect():
        drawn[r["doc_id"]] += r["words"]
    assert {k: v for k, v in drawn.items() if v} == {r["doc_id"]: r["taken"] for r in got if r["taken"]}
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(mixing.sized(frame.repartition(7)), block=16)[0].collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}


def test_schedule_follows_its_weights(spark):
    rows = [(0, "a", 6400, 6400.0), (1, "b", 2000, 2000.4), (2, "c", 100, 90.0), (3, "d", 5, 0.2), (4, None, 12800, 12800.0)]
    sources = spark.createDataFrame(rows, "source_no long, source string, source_size long, target double")
    slots = sorted((r["slot"], r["source_no"], r["rank"]) for r in mixing.schedule(sources, 16).collect())
    want = {0: 400, 1: 125, 2: 6, 4: 800}
    assert Counter(s for _, s, _ in slots) == want
    assert [s for s, _, _ in slots] == list(range(sum(want.values())))
    for number, count in want.items():
        own = [(slot, rank) for slot, s, rank in slots if s == number]
        assert [rank for _, rank in own] == list(range(count))
        for k, (slot, _) in enumerate(own):
            assert abs(k - slot * count / len(slots)) < 6


def test_repeated_and_empty(spark):
    rows = [(1, "a b c", None, "s", 0)] * 4 + [(2, None, None, "s", 0)] * 2 + [(None, "d", None, None, 0)]
    got = mixing.taken_rows(mixing.sized(docs.documents(spark, rows)), block=4).collect()
    assert len(got) == 7 and sum(r["taken"] for r in got) == 13
    assert mixing.taken_rows(mixing.sized(docs.documents(spark, []))).count() == 0
    blank = mixing.taken_rows(mixing.sized(docs.documents(spark, [(1, " ", None, "s", 0)]))).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in blank] == [(0, 0.0, 0)]


def test_main_path_is_native(spark):
    plan = mixing.taken_rows(mixing.sized(docs.documents(spark)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
