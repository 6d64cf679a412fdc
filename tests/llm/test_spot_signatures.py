"""Operator 1 against a plain version of signatures, edits and likeness."""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from filingspark.llm import spot_signatures as spots
from tests.llm import docs


def plain(text: str | None) -> frozenset:
    if not text:
        return frozenset()
    anchors = set(spots.anchor_words())
    words = [w for w in re.split(r"[^\w]+|_", text.lower()) if w]
    content = [(i, w) for i, w in enumerate(words) if w not in anchors]
    found = set()
    for i, w in enumerate(words):
        if w in anchors:
            after = [c for j, c in content if j > i][: spots.CHAIN]
            if len(after) == spots.CHAIN:
                found.add((w, *after))
    return frozenset(found) or frozenset([("words", *words)] if words else [("text", text)])


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_fingerprints(spark, partitions):
    rows = sorted(docs.corpus())
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = docs.documents(spark, rows).selectExpr("*", "1 as _run", "2 as own", "3 as _next").repartition(4)
        got = {r["doc_id"]: r for r in spots.fingerprints(frame).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(got) == [r[0] for r in rows]
    texts = [r[1] or "" for r in rows]
    by_text = {}
    for i, (doc, *_) in enumerate(rows):
        text, after, r = texts[i], texts[(i + 1) % len(texts)], got[doc]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["n_signatures"] == len(plain(text))
        assert r["near_edited"] == pytest.approx(jaccard(plain(text), plain(edited)))
        assert r["near_next"] == pytest.approx(jaccard(plain(text), plain(after)))
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (plain(text) == plain(edited))


def test_awkward_keys(spark):
    rows = [(None, "the old mill stood", None, None, 0), (2, "x", None, None, 0), (2, "x", None, None, 0), (-5, None, None, None, 0)]
    got = spots.fingerprints(docs.documents(spark, rows)).collect()
    assert len(got) == 4
    alone = spots.fingerprints(docs.documents(spark, [(None, "ab", None, None, 0)])).collect()[0]
    assert alone["edited_sha256"] == hashlib.sha256(b"aa").hexdigest() and alone["near_next"] == 1.0
    assert spots.fingerprints(docs.documents(spark, [])).count() == 0


def test_near_duplicates_match_all_pairs(spark):
    rows = docs.corpus()
    signed = docs.documents(spark, rows).select("doc_id", spots.signatures(F.col("text")).alias("signatures"))
    members, pairs = spots.near_duplicates(signed, 0.6)
    sets = {r[0]: plain(r[1]) for r in rows}
    least = {}
    for i in sorted(sets):
        least.setdefault(sets[i], i)
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == {i: least[s] for i, s in sets.items()}
    want = {
        (a, b): jaccard(sets[a], sets[b])
        for a, b in combinations(sorted(least.values()), 2)
        if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.6
    }
    assert {(r["a"], r["b"]): r["likeness"] for r in pairs.collect()} == pytest.approx(want)
    assert want


def test_main_path_is_native(spark):
    plan = spots.fingerprints(docs.documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
