from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from filingspark.functions import clean, dates
from filingspark.functions import vectors as V
from filingspark.operators import candles as P


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column).first()[0]


def test_cik(spark):
    df = spark.createDataFrame([("1",), ("12345678901",), ("0000000000",)], "c string")
    assert [r[0] for r in df.select(clean.pad_cik(F.col("c"))).collect()] == ["0000000001", "12345678901", "0000000000"]
    assert [r[0] for r in df.select(clean.unpad_cik(F.col("c"))).collect()] == ["1", "12345678901", ""]


@pytest.mark.parametrize("text, value", [
    ("5", 5), ("6.9", 6), ("-3.2", -3), ("1e20", 0), (None, 0), ("9007199254740993", 9007199254740993),
    ("9223372036854775808", 0), ("9223372036854775807", 9223372036854775807), ("x", 0),
])
def test_safe_long(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(clean.safe_long(F.col("t"))).first()[0] == value


def test_humanise_equals_python(spark):
    values = [0, 999, 1000, 1001, 1050, 1150, 1250, 1350, 228250, 999950, 999999, 1_000_000, 1_050_000,
              1_250_001, 1_350_000, 2_250_000, 27_000_000, *range(1001, 60000, 50), *range(1_000_050, 9_000_000, 50_000)]

    def python(n):
        if n > 1_000_000:
            return "{:.1f}M".format(n / 1_000_000)
        return "{:.1f}K".format(n / 1_000) if n > 1_000 else str(n)

    df = spark.createDataFrame([(v,) for v in values], "n bigint")
    assert [r[0] for r in df.select(clean.humanise(F.col("n"))).collect()] == [python(v) for v in values]


@pytest.mark.parametrize("text, moment", [
    ("Wed, 22 Jan 2025 13:05:34 -0400", datetime(2025, 1, 22, 17, 5, 34)),
    ("2025-01-22", datetime(2025, 1, 22)),
    ("01/08/2025 12:00 AM", datetime(2025, 1, 8)),
    ("2025-01-10T09:30:00-05:00", datetime(2025, 1, 10, 14, 30)),
    ("1737565534", datetime(2025, 1, 22, 17, 5, 34)),
    ("not a date", None),
])
def test_epoch(spark, text, moment):
    want = None if moment is None else int(moment.replace(tzinfo=timezone.utc).timestamp())
    assert one(spark, dates.epoch(F.col("t")), t=text) == want


def test_time_parts(spark):
    sunday = int(datetime(2025, 3, 9, 7, 30, 59, tzinfo=timezone.utc).timestamp())  # clocks go forward in New York
    df = spark.createDataFrame([(sunday,)], "s bigint")
    row = df.select(
        dates.minute_of_day(F.col("s")), dates.day_of_week(F.col("s")),
        dates.minute_of_day(F.col("s"), "America/New_York"),
        dates.format_epoch(F.col("s") * 1000, "yyyy-MM-dd HH:mm", "America/New_York"),
        dates.format_epoch(F.col("s")),
    ).first()
    assert tuple(row) == (27000, 6, 3 * 3600 + 1800, "2025-03-09 03:30", "2025-03-09")


def plan(start, now, week=7 * 24 * 3600):
    """The rule, by hand."""
    span = now - start
    edges = [start] if span < week else list(range(start, now + 1, span // (span // week)))
    edges.append(now)
    return [(a, b) for a, b in zip(edges, edges[1:]) if a < b]


def test_backfill(spark):
    week, now = 7 * 24 * 3600, 1_700_000_000
    spans = [0, 10, week - 1, week, week + 5, 2 * week, 3 * week + 17, 11 * week + 3]
    df = spark.createDataFrame([(str(s), now - s) for s in spans], "ticker string, latest bigint")
    blocks = P.backfill_windows(df, "ticker", "latest", F.lit(now).cast("bigint")).orderBy("ticker", "block").collect()
    for span in spans:
        assert [(b.from_s, b.to_s) for b in blocks if b.ticker == str(span)] == plan(now - span, now)


def test_metrics(spark):
    df = spark.createDataFrame([([1.0, 2.0, 2.0], [2.0, 0.0, 1.0], [1, 0, 1, 1], [1, 1, 0, 1], ["a", "b"], ["b", "c"])],
                               "a array<float>, b array<float>, x array<int>, y array<int>, s array<string>, t array<string>")
    a, b, x, y = (F.col(c) for c in "abxy")
    row = df.select(V.dot(a, b), V.cosine(a, b), V.l2_distance(a, b), V.hamming(x, y), V.tanimoto(x, y),
                    V.jaccard(F.col("s"), F.col("t")), V.norm(V.l2_normalise(a))).first()
    assert row[0] == 4.0 and row[1] == pytest.approx(4 / (3 * 5 ** 0.5)) and row[2] == pytest.approx(6 ** 0.5)
    assert row[3] == 2 and row[4] == pytest.approx(0.5) and row[5] == pytest.approx(2 / 3) and row[6] == pytest.approx(1)


def test_score_all_equals_expressions(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([0.0, 0.0],), (None,)], "v array<float>")
    queries = [[3.0, 1.0], [-1.0, 0.5]]
    for metric in ("COSINE", "IP", "L2"):
        mine = df.select(V.score_all(F.col("v"), queries, metric).alias("s")).collect()
        each = df.select(*[V.METRICS[metric][0](F.col("v"), V.constant(q)) for q in queries]).collect()
        for m, e in zip(mine, each):
            got = [None, None] if m.s is None else m.s
            assert got == [None if x is None else pytest.approx(x) for x in e]
