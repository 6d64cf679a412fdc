"""Mentions of names of any characters against a search by hand."""

from __future__ import annotations

import random

from filingspark.operators import entities


def _plain(text, names):
    low = entities.folded(text)
    hits = []
    for name, label in names.items():
        at = low.find(name)
        while at >= 0:
            end = at + len(name)
            before = at > 0 and low[at - 1].isalnum() and name[0].isalnum()
            after = end < len(low) and low[end].isalnum() and name[-1].isalnum()
            if not (before or after):
                hits.append((at, end, label))
            at = low.find(name, at + 1)
    return sorted(h for h in hits if not any(o[0] <= h[0] and h[1] <= o[1] and o[:2] != h[:2] for o in hits))


def test_against_a_search_by_hand(spark):
    draw = random.Random(3)
    names = {"".join(draw.choices("ab& .", k=draw.randrange(1, 7))): draw.choice("XY") for _ in range(40)}
    texts = [(i, "".join(draw.choices("aAbB& .é", k=draw.choice([0, 3, 30, 300])))) for i in range(200)]
    df = spark.createDataFrame(texts, "id long, text string")
    gazetteer = spark.createDataFrame(list(names.items()), "name string, label string")
    want = {(i, *hit) for i, t in texts for hit in _plain(t, names)}
    for most in (1000, 7):
        rows = entities.named_mentions(df, "id", "text", gazetteer, most).collect()
        assert {(r["id"], r["start"], r["end"], r["label"]) for r in rows} == want
        assert len(rows) == len(want)
    assert all(r["text"] == dict(texts)[r["id"]][r["start"] : r["end"]] for r in rows)


def test_edge_rows(spark):
    rows = [(1, "AT&T, Inc. and at&t"), (2, None), (3, ""), (None, "x AT&T"), (4, "İ AT&T İ"), (5, "aat&t at&tx"), (5, "at&t")]
    df = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "1 as label", "2 as start", "'y' as _row")
    names = spark.createDataFrame(
        [("AT&T", "ORG"), ("at&t", "FIRM"), ("AT&T, Inc.", "ORG"), (None, "X"), ("", "X"), ("and", None)],
        "name string, label string",
    )
    got = sorted((r["id"] or 0, r["start"], r["end"], r["label"], r["text"])
                 for r in entities.named_mentions(df, "id", "text", names).collect())
    assert got == [
        (0, 2, 6, "FIRM", "AT&T"), (1, 0, 10, "ORG", "AT&T, Inc."), (1, 15, 19, "FIRM", "at&t"),
        (4, 2, 6, "FIRM", "AT&T"), (5, 0, 4, "FIRM", "at&t"),
    ]
    assert entities.named_mentions(df.limit(0), "id", "text", names).count() == 0
    assert entities.named_mentions(df, "id", "text", names.limit(0)).count() == 0
