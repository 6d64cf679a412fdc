"""Streams of candles and articles against the batch operators, across restarts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from filingspark.operators import candles as P
from filingspark.operators import features as N
from filingspark.streaming import candles as live
from filingspark.streaming import loads

CANDLES = "ticker string, datetime long, open double, high double, low double, close double, volume long"
ARTICLES = "id long, ticker string, created long"
DAY = 86_400


def _candles(spark, start, end, seed=1):
    draw, rows = random.Random(seed * 1000 + start), []
    for ticker in ("A", "B", None):
        for at in sorted(draw.sample(range(start, end), (end - start) // 900)):
            price = draw.uniform(0, 9)
            rows.append((ticker, at, price, price * 2, price / 2, draw.uniform(0, 9), draw.randrange(99)))
    return spark.createDataFrame(rows, CANDLES)


def _land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def _sorted(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("minutes", [30, None])
def test_resample_across_a_restart(spark, tmp_path, minutes):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    parts = [_candles(spark, day * DAY, (day + 1) * DAY) for day in range(4)]
    for run in (parts[:2], parts[2:]):
        for part in run:
            _land(part, source)
        stream = live.resample_stream(loads.read_landed(spark, source, CANDLES, 1), minutes, "10 minutes")
        query = loads.run_append(stream, target, state)
    assert live.late_rows(query) == 0
    everything = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    closed = everything.agg(F.max("datetime") - 600).first()[0]
    whole = P.resample(everything, "minute", minutes) if minutes else P.resample(everything, "daily")
    width = 60 * minutes if minutes else DAY
    columns = ["ticker", "datetime", "open", "high", "low", "close", "volume"]
    want = _sorted(whole.where(F.col("datetime") + width <= closed).select(columns))
    assert _sorted(spark.read.parquet(target).select(columns)) == want and want
    assert 0 < live.state_rows(query) < len(want)


def test_late_candles_are_counted(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows in ([("A", 100, 1.0)], [("A", 90_000, 2.0)], [("A", 200, 9.0), ("A", 90_100, 3.0)], [("A", 200_000, 1.0)]):
        _land(spark.createDataFrame([(t, at, o, o, o, o, 1) for t, at, o in rows], CANDLES), source)
        stream = live.resample_stream(loads.read_landed(spark, source, CANDLES, 1), 5, "1 minute")
        query = loads.run_append(stream, target, state)
        if rows[0][1] == 200:
            assert live.late_rows(query) == 1
    assert [(r.datetime, r.open, r.close) for r in spark.read.parquet(target).orderBy("datetime").collect()] == [
        (0, 1.0, 1.0), (90_000, 2.0, 3.0)
    ]


def test_labels_and_their_state(spark, tmp_path):
    news, prices, target, state = (str(tmp_path / n) for n in ("news", "prices", "out", "state"))
    draw = random.Random(4)
    candles = [_candles(spark, day * DAY, (day + 1) * DAY, 2) for day in range(6)]
    articles = [
        spark.createDataFrame(
            [(100 * day + i, draw.choice(["A", "B", "C", None]), day * DAY + draw.randrange(DAY)) for i in range(30)], ARTICLES
        )
        for day in range(6)
    ]
    states = []
    for run in ((0, 1, 2), (3, 4, 5)):
        for day in run:
            _land(articles[day], news)
            _land(candles[day], prices)
        stream = live.label_stream(
            loads.read_landed(spark, news, ARTICLES, 1), loads.read_landed(spark, prices, CANDLES, 1), "10 minutes", max_gap=3600
        )
        query = loads.run_append(stream, target, state)
        states.append(live.state_rows(query))
    assert live.late_rows(query) == 0
    every, prices_of = articles[0], candles[0]
    for a, c in zip(articles[1:], candles[1:]):
        every, prices_of = every.unionByName(a), prices_of.unionByName(c)
    last = min(every.agg(F.max("created")).first()[0], prices_of.agg(F.max("datetime")).first()[0]) - 600
    want = N.price_labels(every, prices_of, max_gap=3600)
    columns = ["id", "ticker", "created", *N.LABELS]
    found = spark.read.parquet(target).select(columns)
    assert found.count() == found.select("id").distinct().count()
    done = F.col("created") < last - DAY - 60
    assert _sorted(found.where(done)) == _sorted(want.where(done).select(columns))
    assert {-1, 0, 1, 2} >= {r[0] for r in found.select("day_gain_24").distinct().collect()} and found.count() > 90
    kept = every.where(F.col("created") > last - 2 * DAY).count() + prices_of.where(F.col("datetime") > last - 2 * DAY).count()
    assert states[1] <= 2 * kept < every.count() + prices_of.count()  # a day or two, not all of it


def test_fresh_rows_across_a_restart(spark, tmp_path):
    spark.conf.set(live.STATE_STORE, live.ROCKSDB)
    try:
        source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
        schema = "key string, t long, v string"
        batches = [
            [("a", 5, "old"), ("a", 7, "x"), ("b", 0, "too old"), (None, 9, "n"), ("b", None, "n")],
            [("a", 7, "again"), ("a", 8, "y"), ("a", 6, "late"), ("c", 3, "z")],
            [("a", 8, "again"), ("b", 1, "w"), ("b", 1, "same batch"), ("c", 2, "late")],
        ]
        for batch in batches:  # a run each, with the same checkpoint
            _land(spark.createDataFrame(batch, schema), source)
            stream = live.fresh_stream(loads.read_landed(spark, source, schema, 1), "key", "t", 0)
            loads.run_append(stream, target, state)
        found = sorted(r.v for r in spark.read.parquet(target).collect())
        assert found == ["old", "same batch", "w", "x", "y", "z"]
    finally:
        spark.conf.unset(live.STATE_STORE)
