"""Price candles: resampling, sessions, quotes, and the candles around an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingspark.functions import dates
from filingspark.operators.keys import spread_join

MINUTES = (1, 5, 10, 15, 30)
CALENDAR = {"daily": "day", "weekly": "week", "monthly": "month"}


def resample(candles: DataFrame, frequency: str = "minute", minutes: int = 1) -> DataFrame:
    """Coarser candles; ``frequency`` is minute, daily, weekly (from Monday) or monthly.

    ``datetime`` becomes the epoch second at which the coarser candle starts.
    """
    if frequency == "minute":
        if minutes not in MINUTES:
            raise ValueError(f"minutes must be one of {MINUTES}")
        start = F.col("datetime") - F.pmod("datetime", F.lit(60 * minutes))
    else:
        moment = F.timestamp_seconds("datetime")
        start = F.unix_timestamp(F.date_trunc(CALENDAR[frequency], moment))
    return candles.groupBy("ticker", start.alias("start")).agg(
        F.min_by("open", "datetime").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "datetime").alias("close"),
        F.sum("volume").alias("volume"),
    ).withColumnRenamed("start", "datetime")


def latest_quote(candles: DataFrame, tickers: Sequence[str] | None = None) -> DataFrame:
    if tickers is not None:
        candles = candles.where(F.col("ticker").isin(*tickers))
    row = F.struct("datetime", "open", "high", "low", "close", "volume")
    return candles.groupBy("ticker").agg(F.max(row).alias("_q")).select("ticker", "_q.*")


def previous_close(daily: DataFrame) -> DataFrame:
    """The close of the session before, per ticker. Input has one row per ticker and day."""
    order = Window.partitionBy("ticker").orderBy("datetime")
    return daily.withColumn("previous_close", F.lag("close").over(order))


def by_session(candles: DataFrame, sessions: DataFrame, extended: bool = False) -> DataFrame:
    """Candles inside the regular session of their day, or outside it.

    ``sessions`` holds ``is_open``, ``start`` and ``end`` per day. A session is listed
    under each UTC day that it touches, one row per day, a few hundred a year
    whatever the number of candles, which is what allows to broadcast it.
    """
    days = F.sequence(F.expr("start div 86400L"), F.expr("end div 86400L"))
    calendar = (
        sessions.where("is_open and start <= end")
        .select("start", "end", F.explode(days).alias("_day"))
        .groupBy("_day")
        .agg(F.collect_set(F.struct("start", "end")).alias("_open"))
    )
    inside = (F.expr("datetime div 86400L") == F.col("_day")) & F.exists(
        "_open", lambda s: F.col("datetime").between(s["start"], s["end"])
    )
    return candles.join(F.broadcast(calendar), inside, "left_anti" if extended else "left_semi")


def last_session(calendar: DataFrame, today) -> DataFrame:
    """The last open day before ``today`` and its session start."""
    past = calendar.where(F.col("is_open") & (F.col("day") < today))
    return past.agg(F.max("day").alias("day"), F.max_by("start", "day").alias("start"))


def backfill_windows(watermarks: DataFrame, key: str, start: str, now) -> DataFrame:
    """Blocks ``(key, block, from_s, to_s)`` that cover start to now, none of zero width."""
    edges = dates.backfill_edges(F.col(start), now)
    numbered = watermarks.where(F.col(start) <= now).select(key, edges.alias("e"))
    pairs = F.transform(
        F.slice("e", F.lit(1), F.size("e") - 1),
        lambda x, i: F.struct(x.alias("from_s"), F.get("e", i + 1).alias("to_s")),
    )
    blocks = numbered.select(key, F.posexplode(pairs).alias("block", "b"))
    return blocks.select(key, "block", "b.from_s", "b.to_s").where("from_s < to_s")


def candles_around(
    events: DataFrame,
    candles: DataFrame,
    at: str,
    after: int,
    until: int,
    fields: Sequence[str],
    event_id: str = "id",
    base: DataFrame | None = None,
) -> DataFrame:
    """Each event with ``window``: its ticker's candles in ``(at + after, at + until]``, by time.

    Time is cut into buckets as long as the range, so a range touches a bucket
    and the next one. Candles are copied to both and gathered per ticker and
    bucket; an event then meets its candles by one equi join. Candles are unique
    per ticker and second, so a gathered list is bounded by two range lengths in
    seconds however large the table is, and only buckets with an event are
    gathered. Events of a hot ticker and bucket are spread by ``spread_join``.

    The events are read twice, for their buckets and for the join. When they are
    costly to make, pass ``base``: a table that holds at least their tickers and
    times, from which the buckets and their sizes are taken instead.
    """
    width = until - after
    bucket = F.floor((F.col(at) + after) / width).alias("_bucket")
    bucketed = events.select(*events.columns, bucket)
    sizes = (
        (events if base is None else base).where(F.col("ticker").isNotNull())
        .groupBy("ticker", bucket).agg(F.count("*").alias("_n"))
    )
    own = F.floor(F.col("datetime") / width)
    entry = F.struct("datetime", *fields)
    lists = (
        candles.select("ticker", entry.alias("_c"), F.explode(F.array(own, own - 1)).alias("_bucket"))
        .join(sizes, ["ticker", "_bucket"], "left_semi")
        .groupBy("ticker", "_bucket")
        .agg(F.sort_array(F.collect_list("_c")).alias("_list"))
    )
    joined = spread_join(bucketed, lists, ["ticker", "_bucket"], "left", [event_id], counts=sizes)
    first, last = F.col(at) + after, F.col(at) + until
    near = F.filter("_list", lambda c: (c["datetime"] > first) & (c["datetime"] <= last))
    return joined.withColumn("window", F.coalesce(near, F.array().cast(lists.schema["_list"].dataType)))\
        .drop("_list", "_bucket")
