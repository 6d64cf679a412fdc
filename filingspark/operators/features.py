"""News-to-price features: labels, volume trend, and the labelled table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingspark.functions import dates
from filingspark.operators.candles import candles_around
from filingspark.operators.companies import screener_enrich
from filingspark.operators.keys import first_wins, spread_join
from filingspark.operators.query import focused_articles

DAY_S = 24 * 3600
DELAY_S = 60
PRICES = ["open", "high", "low", "close"]
LABELS = ("max_gain_24", "day_gain_24", "max_loss_24")


def ternary(value: Column, threshold: float) -> Column:
    return F.when(value > threshold, 2).when(value < -threshold, 0).otherwise(1)


def window_prices(
    events: DataFrame,
    candles: DataFrame,
    at: str = "created",
    delay: int = DELAY_S,
    span: int = DAY_S,
    event_id: str = "id",
    base: DataFrame | None = None,
) -> DataFrame:
    """Events with the first candle after ``delay`` and the OHLC of the range.

    Adds ``open_at``, ``open``, ``high``, ``low`` and ``close``, all NULL when no
    candle falls into the range.
    """
    near = candles_around(events, candles, at, delay, span, PRICES, event_id, base)
    return _prices(near, events.columns)


def _prices(near: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` and the figures of the candles in ``window``."""
    first, last = F.get("window", F.lit(0)), F.try_element_at("window", F.lit(-1))
    return near.select(
        *columns,
        first["datetime"].alias("open_at"),
        first["open"].alias("open"),
        F.array_max(F.transform("window", lambda c: c["high"])).alias("high"),
        F.array_min(F.transform("window", lambda c: c["low"])).alias("low"),
        last["close"].alias("close"),
    )


def price_labels(
    events: DataFrame,
    candles: DataFrame,
    at: str = "created",
    delay: int = DELAY_S,
    span: int = DAY_S,
    max_gap: int = 20 * 60,
    threshold: float = 0.5,
    event_id: str = "id",
    base: DataFrame | None = None,
) -> DataFrame:
    """Three labels per event: 2 above, 0 below, 1 within the threshold, -1 not usable.

    An event is not usable without a candle in the range, when the first one
    comes more than ``max_gap`` seconds after it, or when that one opens at 0.
    """
    priced = window_prices(events, candles, at, delay, span, event_id, base)
    return label_prices(priced, events.columns, at, max_gap, threshold)


def label_prices(
    priced: DataFrame, columns: Sequence[str], at: str, max_gap: int, threshold: float
) -> DataFrame:
    """``columns`` and the three labels of rows with ``open_at, open, high, low, close``."""
    open_ = F.col("open")
    usable = F.coalesce((F.col("open_at") - F.col(at) <= max_gap) & (open_ != 0), F.lit(False))
    sources = dict(zip(LABELS, ("high", "close", "low")))
    return priced.select(
        *columns,
        *[
            F.when(usable, ternary(F.try_divide(F.col(price) - open_, open_), threshold))
            .otherwise(-1)
            .alias(label)
            for label, price in sources.items()
        ],
    )


def _median(values: Column) -> Column:
    ordered = F.array_sort(values)
    n = F.size(ordered)
    middle = [F.get(ordered, F.floor((n - k) / 2).cast("int")) for k in (1, 0)]
    low, high = middle
    return F.when(n % 2 == 1, low.cast("double")).otherwise((low + high) / 2.0)


def volume_trend(
    events: DataFrame,
    candles: DataFrame,
    at: str = "created",
    short: int = 300,
    long: int = 3600,
    event_id: str = "id",
    base: DataFrame | None = None,
) -> DataFrame:
    """Median volume of the last ``short`` over the last ``long`` seconds.

    NULL when either range is empty or the long median is 0.
    """
    near = candles_around(events, candles, at, -long, 0, ["volume"], event_id, base)
    return near.select(*events.columns, _trend(F.col("window"), at, short).alias("volume_trend"))


def _trend(window: Column, at: str, short: int) -> Column:
    """Median volume of the last ``short`` seconds of ``window`` over that of all of it."""
    recent = F.filter(window, lambda c: c["datetime"] > F.col(at) - short)
    return F.try_divide(*[_median(F.transform(w, lambda c: c["volume"])) for w in (recent, window)])


def labelled_articles(
    articles: DataFrame,
    candles: DataFrame,
    screener: DataFrame,
    first_time: int,
    max_gap: int = 20 * 60,
    threshold: float = 0.5,
    short: int = 300,
    long: int = 3600,
) -> DataFrame:
    """The feature table: one row per focused article, labels, trend, weekday, screener.

    Articles from ``first_time`` up to a day before the last candle of their
    ticker take part. Hot tickers are counted once, on the article table, for
    all joins. The candles before and after an article are gathered together, so
    labels and trend come from one join.
    """
    last = candles.groupBy("ticker").agg((F.max("datetime") - DAY_S).alias("_last"))
    base = articles.where(F.col("created") >= first_time).select("ticker", "created")
    sizes = base.where("ticker IS NOT NULL").groupBy("ticker").agg(F.count("*").alias("_n"))
    timely = spread_join(
        focused_articles(articles).where(F.col("created") >= first_time),
        last,
        ["ticker"],
        spread_on=["id"],
        counts=sizes,
    ).where(F.col("created") <= F.col("_last"))
    once = first_wins(
        timely.select("id", "ticker", "author", "created", "title"),
        ["id", "ticker"], ["created"], null_keys=False,
    )
    near = candles_around(once, candles, "created", -long, DAY_S, [*PRICES, "volume"], "id", base)
    at = F.col("created")
    cut = near.select(
        *once.columns,
        _trend(F.filter("window", lambda c: c["datetime"] <= at), "created", short).alias("volume_trend"),
        F.filter("window", lambda c: c["datetime"] > at + DELAY_S).alias("window"),
    )
    kept = [*once.columns, "volume_trend"]
    labels = label_prices(_prices(cut, kept), kept, "created", max_gap, threshold)
    dated = labels.withColumns(
        {
            "day_of_week": dates.day_of_week(F.col("created")),
            "title": F.coalesce("title", F.lit("")),
            "ticker": F.coalesce("ticker", F.lit("")),
        }
    )
    return screener_enrich(dated, screener, sizes)


def group_split(df: DataFrame, key: str, seed: str = "0", percent: int = 80) -> DataFrame:
    """Adds ``split``, train or test, the same for all rows of a key on every run."""
    digest = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col(key))), 1, 8), 16, 10)
    bucket = F.pmod(digest.cast("bigint"), F.lit(100))
    return df.where(F.col(key).isNotNull()).withColumn(
        "split", F.when(bucket < percent, "train").otherwise("test")
    )


def unpivot_labels(features: DataFrame, names: Sequence[str] = LABELS) -> DataFrame:
    return features.unpivot(["id"], list(names), "horizon", "label")
