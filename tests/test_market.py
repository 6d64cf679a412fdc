from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from filingspark.operators import candles as P
from filingspark.operators import features as N
from filingspark.operators import query as Q
from filingspark.operators import stats

CANDLE = "ticker string, datetime bigint, open double, high double, low double, close double, volume bigint"
T = 1_700_000_000


def candle(at, price, volume=1, ticker="A"):
    return (ticker, at, float(price), price * 1.1, price * 0.9, float(price), volume)


def label(spark, candles, **options):
    events = spark.createDataFrame([(1, "A", T)], "id int, ticker string, created bigint")
    frame = spark.createDataFrame(candles, CANDLE)
    row = N.price_labels(events, frame, **options).first()
    return row.max_gain_24, row.day_gain_24, row.max_loss_24


@pytest.mark.parametrize("candles, want", [
    ([], (-1, -1, -1)),
    ([candle(T + 60, 10)], (-1, -1, -1)),
    ([candle(T + 61, 10)], (1, 1, 1)),
    ([candle(T + 61, 10), candle(T + 86400, 16)], (2, 2, 1)),
    ([candle(T + 61, 10), candle(T + 86401, 16)], (1, 1, 1)),
    ([candle(T + 1200, 10)], (1, 1, 1)),
    ([candle(T + 1201, 10)], (-1, -1, -1)),
    ([candle(T + 61, 0)], (-1, -1, -1)),
    ([candle(T + 61, 10), candle(T + 70, 15)], (2, 1, 1)),
    ([candle(T + 61, 10), candle(T + 70, 5)], (1, 1, 0)),
    ([candle(T + 61, 10, ticker="B")], (-1, -1, -1)),
])
def test_labels(spark, candles, want):
    assert label(spark, candles) == want


def trend(spark, volumes):
    events = spark.createDataFrame([(1, "A", T)], "id int, ticker string, created bigint")
    frame = spark.createDataFrame([candle(t, 1, v) for t, v in volumes], CANDLE)
    return N.volume_trend(events, frame).first().volume_trend


def test_volume_trend_edges(spark):
    assert trend(spark, [(T, 4), (T - 400, 2)]) == pytest.approx(4 / 3)
    assert trend(spark, [(T, 4), (T - 3600, 100)]) == 1.0
    assert trend(spark, [(T, 0), (T - 10, 0)]) is None
    assert trend(spark, [(T - 301, 5)]) is None
    assert trend(spark, [(T - 300, 5), (T - 299, 7)]) == pytest.approx(7 / 6)
    assert trend(spark, [(T + 1, 5)]) is None


def test_windows_against_brute_force(spark):
    rng = random.Random(3)
    seconds = rng.sample(range(T, T + 400_000), 900)
    candles = [(rng.choice("AAAB"), s, rng.uniform(1, 9), rng.uniform(5, 12), rng.uniform(0, 4), rng.uniform(1, 9), rng.randint(0, 9)) for s in seconds]
    events = [(i, rng.choice(["A", "A", "B", "C", None]), T + rng.randint(-5000, 405_000)) for i in range(300)]
    frame = spark.createDataFrame(candles, CANDLE)
    news = spark.createDataFrame(events, "id int, ticker string, created bigint")
    priced = {r.id: r for r in N.window_prices(news, frame).collect()}
    trends = {r.id: r.volume_trend for r in N.volume_trend(news, frame, short=9000, long=50_000, base=news).collect()}
    assert len(priced) == len(trends) == len(events)
    for i, ticker, at in events:
        near = sorted(c[1:] for c in candles if c[0] == ticker and at + 60 < c[1] <= at + 86400)
        want = (near[0][0], near[0][1], max(c[2] for c in near), min(c[3] for c in near), near[-1][4]) if near else (None,) * 5
        r = priced[i]
        assert (r.open_at, r.open, r.high, r.low, r.close) == want
        long = [c[6] for c in candles if c[0] == ticker and at - 50_000 < c[1] <= at]
        short = [c[6] for c in candles if c[0] == ticker and at - 9000 < c[1] <= at]
        usable = long and short and statistics.median(long)
        assert trends[i] == (pytest.approx(statistics.median(short) / statistics.median(long)) if usable else None)


def test_resample_week_starts_monday(spark):
    sunday, monday = 1704585600, 1704672000
    frame = spark.createDataFrame([candle(sunday, 1, 2), candle(monday, 3, 4), candle(monday + 60, 5, 6)], CANDLE)
    weeks = {r.datetime: (r.open, r.close, r.volume) for r in P.resample(frame, "weekly").collect()}
    assert weeks == {1704067200: (1.0, 1.0, 2), monday: (3.0, 5.0, 10)}
    five = P.resample(frame, "minute", 5)
    assert five.count() == 2
    with pytest.raises(ValueError):
        P.resample(frame, "minute", 7)


def test_last_session_and_hours(spark):
    days = spark.createDataFrame(
        [("2025-01-09", False, None, None), ("2025-01-08", True, 100, 200), ("2025-01-10", True, 300, 400), ("2025-01-07", True, 10, 20)],
        "day string, is_open boolean, start bigint, end bigint",
    )
    assert tuple(P.last_session(days, "2025-01-10").first()) == ("2025-01-08", 100)
    frame = spark.createDataFrame([candle(t, 1) for t in (86400 + 99, 86400 + 100, 86400 + 200, 86400 + 201, 5)], CANDLE)
    sessions = spark.createDataFrame([(True, 86400 + 100, 86400 + 200), (False, 0, 10)], "is_open boolean, start bigint, end bigint")
    assert sorted(r.datetime for r in P.by_session(frame, sessions).collect()) == [86500, 86600]
    assert sorted(r.datetime for r in P.by_session(frame, sessions, extended=True).collect()) == [5, 86499, 86601]


@pytest.mark.parametrize("values, counts", [
    ([3.0, 3.0, 3.0], [0, 0, 3, 0]), ([0.0, 1.0, 4.0, 4.0], [1, 1, 0, 2]), ([None, 0.0, 4.0], [1, 0, 0, 1]),
])
def test_histogram(spark, values, counts):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    bins = stats.histogram(df, "x", 4).orderBy("bin").collect()
    assert [b.n for b in bins] == counts
    assert sum(b.percent for b in bins) == pytest.approx(100)


def test_histogram_of_nulls(spark):
    assert stats.histogram(spark.createDataFrame([(None,)], "x double"), "x").count() == 0


def test_table_query(spark):
    df = spark.createDataFrame([(0, "", 3), (1, "b", 2), (0, "c", 1), (0, "", 3)], "a int, b string, c int")
    assert [r.c for r in Q.table_query(df, ["c"], [("a", "eq", 0)], sort="c").collect()] == [3, 3, 1]
    assert Q.table_query(df, where=[("b", "eq", "")]).count() == 2
    assert Q.table_query(df, where=[("a", "gt", None)]).count() == 4
    assert [r.c for r in Q.table_query(df, ["c"], distinct=True, sort="c", descending=False).collect()] == [1, 2, 3]
    assert [r.a for r in Q.table_query(df, ["a"], sort="c", limit=1, descending=False).collect()] == [0]
    least = Q.table_query(df, ["a", "b", "c"], distinct="a", sort="a", descending=False).collect()
    assert [tuple(r) for r in least] == [(0, "", 3), (1, "b", 2)]


def test_article_on_two_tickers_gives_two_rows(spark):
    articles = spark.createDataFrame(
        [(1, t, 1000, "x", "T", ["A", "B"]) for t in ("A", "B")] + [(1, "A", 2000, "x", "T", ["A", "B"])],
        "id int, ticker string, created long, author string, title string, stocks array<string>",
    )
    candles = spark.createDataFrame(
        [(t, s, 1.0, 2.0, 0.5, 1.0, 10) for t in ("A", "B") for s in (900, 1100, 200_000)],
        "ticker string, datetime long, open double, high double, low double, close double, volume long",
    )
    screener = spark.createDataFrame(
        [("A", 5, "US", "s", "i")], "symbol string, market_cap long, country string, sector string, industry string"
    )
    found = sorted((r.id, r.ticker, r.created, r.max_gain_24) for r in N.labelled_articles(articles, candles, screener, 0).collect())
    assert found == [(1, "A", 1000, 2), (1, "B", 1000, 2)]


def test_windows_need_an_end(spark):
    df = spark.createDataFrame([], "id int, ticker string")
    with pytest.raises(ValueError):
        Q.news_feed(df, page=-1)
    with pytest.raises(ValueError):
        Q.paged_query(df, "true", ["id"], ["id"], offset=5)


def test_news_feed_topics_and_paging(spark):
    df = spark.createDataFrame(
        [(1, 10, 11, "x", "Gold up", "", "body", ["tag"], ["A"], ["m"]),
         (2, 20, 21, "y", "other", "", "GOLD inside", ["tag"], ["A"], ["m"]),
         (3, 30, 31, "x", "other", "", "body", ["gold"], ["B"], ["n"]),
         (4, 40, 41, "x", "none", "", "body", ["tag"], ["B"], ["n"])],
        "id int, created int, updated int, author string, title string, teaser string, body string, "
        "tags array<string>, stocks array<string>, channels array<string>",
    )
    assert [r.id for r in Q.news_feed(df, topics=["gold"], page=0).collect()] == [1, 3, 2]
    assert [r.id for r in Q.news_feed(df, sort="id:asc", page=1, page_size=3).collect()] == [4]
    assert Q.news_feed(df, page=5).count() == 0
    assert {r.id for r in Q.news_feed(df, authors=["x"], channels=["n"], date_from=30, date_to=30).collect()} == {3}
    assert Q.news_feed(df, "full").columns[-1] == "body"


def test_group_split_keeps_keys_together(spark):
    df = spark.range(2000).select(F.concat(F.lit("T"), F.col("id") % 200).alias("ticker"))
    split = N.group_split(df, "ticker")
    assert split.groupBy("ticker").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    share = split.where("split = 'train'").select("ticker").distinct().count() / 200
    assert 0.7 < share < 0.9
