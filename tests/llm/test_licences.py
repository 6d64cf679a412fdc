"""Operator 7: planted notices are found, plain text and shuffled words are not."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from filingspark.llm import licences
from tests.llm import docs


@pytest.fixture(scope="module")
def planted():
    draw = random.Random(8)
    rows, want = [], set()
    families = [(f, t) for f, texts in licences.TEMPLATES.items() for t in texts]
    for i in range(240):
        lines = [" ".join(draw.choices(docs.LEXICON, k=draw.randint(1, 40))) for _ in range(draw.randint(1, 6))]
        if i % 4 == 0:
            family, text = families[i // 4 % len(families)]
            at = draw.randrange(len(lines) + 1)
            lines.insert(at, text.upper() if i % 8 else text)
            want.add((i, at, family))
        rows.append((i, "\n".join(lines), "en", "s", 0))
    return rows, want


@pytest.fixture(scope="module")
def classifier(spark, planted):
    return licences.train(docs.documents(spark, planted[0]), negatives=2000)


def test_planted_notices(spark, planted, classifier):
    rows, want = planted
    got = licences.scan(docs.documents(spark, rows).selectExpr("*", "1 as family", "2 as words"), classifier).collect()
    found = {(r["doc_id"], r["paragraph"], r["family"]) for r in got}
    assert len(found & want) >= 0.97 * len(want)
    assert len(found - want) <= 0.02 * len(want)
    assert all(r["confirmed"] and r["likeness"] == 1.0 for r in got if (r["doc_id"], r["paragraph"], r["family"]) in want)


def test_awkward_rows(spark, classifier):
    notice = licences.TEMPLATES["MIT"][0]
    far = " ".join(["river stone"] * 3000) + " " + notice
    rows = [(1, None, None, None, 0), (2, "", None, None, 0), (3, "\n\n \n", None, None, 0), (4, notice, None, None, 0),
            (4, notice, None, None, 0), (5, f"\n\n{notice}", None, None, 0), (6, "x" * 200_000, None, None, 0), (7, far, None, None, 0)]
    got = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in licences.scan(docs.documents(spark, rows), classifier).collect())
    assert [g for g in got if g[0] < 7] == [(4, 0, "MIT"), (4, 0, "MIT"), (5, 2, "MIT")]
    assert licences.scan(docs.documents(spark, []), classifier).count() == 0


def test_notices_inside_long_lines(spark, classifier):
    draw = random.Random(9)
    texts = [t for family in licences.TEMPLATES.values() for t in family]
    families = [f for f, family in licences.TEMPLATES.items() for _ in family]
    far = " ".join(["river stone"] * 3000)
    rows = [(0, f"{far} {licences.TEMPLATES['MIT'][0]}", None, None, 0)]
    for i, text in enumerate(texts, 1):
        own = draw.choices(docs.LEXICON, k=draw.randint(200, 900))
        at = draw.randrange(len(own))
        rows.append((i, " ".join([*own[:at], text, *own[at:]]), None, None, 0))
    plain = [(100 + i, " ".join(draw.choices(docs.LEXICON, k=900)), None, None, 0) for i in range(20)]
    got = licences.scan(docs.documents(spark, rows + plain), classifier).collect()
    told = {(r["doc_id"], r["family"]) for r in got if r["confirmed"] and r["likeness"] == 1.0}
    want = {(0, "MIT"), *enumerate(families, 1)}
    assert (0, "MIT") in told and len(told & want) >= 0.95 * len(want)
    assert all(r["paragraph"] == 0 for r in got) and not [r for r in got if r["doc_id"] >= 100]


def test_empty_corpus_trains(spark):
    assert licences.train(docs.documents(spark, []), negatives=10).temperature > 0


def test_words_and_grams(spark):
    frame = spark.createDataFrame([("CC BY-NC 4.0.",), ("one",), ("",)], "t string")
    got = frame.select(licences.grams(licences.words_of(F.col("t")))).collect()
    assert [r[0] for r in got] == [["cc", "by-nc", "4.0", "cc by-nc", "by-nc 4.0"], ["one"], []]


def test_main_path_is_native(spark, classifier):
    plan = licences.scan(docs.documents(spark), classifier)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
