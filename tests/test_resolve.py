"""Many names resolved against titles, next to plain substring search."""

from __future__ import annotations

import random

from filingspark.operators import companies as C


def test_resolve_companies(spark):
    draw = random.Random(3)
    titles = ["".join(draw.choices("abAB é", k=draw.randint(0, 9))) for _ in range(150)] + ["aaaaaaaa", "aa", None, "", "漢字 co"]
    rows = [(str(i), t) for i, t in enumerate(titles)] + [("77", "aaaaaaaa"), ("78", "aa"), (None, "aa"), ("78", "aa")]
    names = ["".join(draw.choices("abAB é", k=draw.randint(1, 6))) for _ in range(80)] + ["a", "aa", "aaa", "字", "zz", "", None, "aa"]
    symbols = spark.createDataFrame(rows, "cik_str string, title string")
    asked = spark.createDataFrame([(n, 1) for n in names], "who string, title int")
    want = sorted({(n, c, t) for n in names if n for c, t in rows if t is not None and n in t}, key=repr)
    for rows_per_task in (None, 5):
        found = C.resolve_companies(symbols, asked, "who", rows_per_task=rows_per_task)
        assert sorted(map(tuple, found.collect()), key=repr) == want
    assert C.resolve_companies(symbols, asked.limit(0), "who").count() == 0
    assert C.resolve_companies(symbols.limit(0), asked, "who").count() == 0
