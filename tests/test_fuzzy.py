"""Many fuzzy terms against the plain edit distance."""

from __future__ import annotations

import random
import re

import pytest

from filingspark.operators import fuzzy


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _edits(term, fuzziness):
    return int(fuzziness) if fuzziness != "AUTO" else 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def _changed(draw, word):
    letters = list(word)
    for _ in range(draw.randrange(4)):
        at = draw.randrange(len(letters) + 1)
        letters[at : at + draw.randrange(2)] = draw.choice(["", "a", "ü", "b"])
    return "".join(letters)


def _words(count, seed):
    draw = random.Random(seed)
    found = {"".join(draw.choices("abcü", k=draw.choice([1, 2, 3, 5, 6, 9, 23, 24, 25, 26, 27, 40]))) for _ in range(count)}
    return sorted(found | {_changed(draw, w) for w in found} | {_changed(draw, w) for w in found} - {""})


@pytest.mark.parametrize("fuzziness", ["AUTO", "0", "1", "2"])
def test_all_near_pairs_are_found(spark, fuzziness):
    words, terms = _words(150, 1), _words(60, 1) + [""]
    got = fuzzy.near_words(
        spark.createDataFrame([(w,) for w in words] + [(None,)], "word string"),
        spark.createDataFrame([(t,) for t in terms] + [(None,)], "term string"), fuzziness,
    )
    want = {
        (w, t, _distance(w, t)) for w in words for t in terms
        if w and t and abs(len(w) - len(t)) <= 2 and _distance(w, t) <= _edits(t, fuzziness)
    }
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_texts(spark, monkeypatch):
    texts = [(1, "Hallo hello HELLO, world"), (2, None), (3, ""), (4, "hxllo wurld x" * 50), (None, "hello"), (1, "helo hello")]
    df = spark.createDataFrame(texts, "id long, text string").selectExpr("*", "'x' as word", "1 as term")
    terms = spark.createDataFrame([("Hello",), ("hello",), ("wOrld",), (None,), ("",), ("absent",)], "term string")
    want = set()
    for key in (1, 2, 3, 4, None):
        words = {w for k, t in texts if k == key for w in re.findall(r"[^\W_]+", (t or "").lower())}
        for term in ("hello", "world", "absent"):
            near = [w for w in words if _distance(w, term) <= _edits(term, "AUTO")]
            if near:
                want.add((key, term, len(near)))
    assert {tuple(r) for r in fuzzy.fuzzy_many(df, "id", "text", terms).collect()} == want
    monkeypatch.setattr(fuzzy, "BROADCAST_ROWS", 0)
    assert {tuple(r) for r in fuzzy.fuzzy_many(df, "id", "text", terms).collect()} == want
    assert fuzzy.fuzzy_many(df.limit(0), "id", "text", terms).count() == 0
    assert fuzzy.fuzzy_many(df, "id", "text", terms.limit(0)).count() == 0


def test_unknown_fuzziness_is_refused(spark):
    df = spark.createDataFrame([(1, "a")], "id long, text string")
    with pytest.raises(ValueError):
        fuzzy.fuzzy_many(df, "id", "text", df.selectExpr("text as term"), "3")
