"""Candles and labels as they arrive: event-time windows, interval joins, and state per key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from filingspark.operators.candles import MINUTES
from filingspark.operators.features import DAY_S, DELAY_S, label_prices

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def resample_stream(candles: DataFrame, minutes: int | None = 5, lateness: str = "1 hour") -> DataFrame:
    """Coarser candles of a stream, each once, when its window is closed.

    ``minutes`` as for ``operators.candles.resample``, None for days. A window is closed when
    a candle has come that is newer than its end by ``lateness``; candles that come later
    than that are dropped and counted (``late_rows``). The state holds one row per ticker
    and open window. Candles are expected once per ticker and second.
    """
    if minutes is not None and minutes not in MINUTES:
        raise ValueError(f"minutes must be one of {MINUTES}")
    timed = candles.withColumn("_at", F.timestamp_seconds("datetime")).withWatermark("_at", lateness)
    width = "1 day" if minutes is None else f"{minutes} minutes"
    coarse = timed.groupBy("ticker", F.window("_at", width).alias("_window")).agg(
        F.min_by("open", "datetime").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "datetime").alias("close"),
        F.sum("volume").alias("volume"),
    )
    start = F.unix_timestamp("_window.start").alias("datetime")
    return coarse.select("ticker", start, "open", "high", "low", "close", "volume")


def label_stream(
    articles: DataFrame,
    candles: DataFrame,
    lateness: str = "1 hour",
    delay: int = DELAY_S,
    span: int = DAY_S,
    max_gap: int = 20 * 60,
    threshold: float = 0.5,
) -> DataFrame:
    """Labels of ``id, ticker, created`` articles, each once, when the candles of its range are in.

    A join of the two streams on the ticker and the range of time, summed up per article.
    Both sides are kept for as long as the other may still bring a partner: articles for
    ``span`` and candles for no longer than the lateness, by the watermark of the slower stream. An
    article without a candle is emitted as well, as not usable. Rows later than
    ``lateness`` are dropped and counted (``late_rows``).
    """
    left = articles.select("id", "ticker", "created", F.timestamp_seconds("created").alias("_at")).withWatermark("_at", lateness)
    right = candles.select(
        F.col("ticker").alias("_ticker"), "datetime", "open", "high", "low", "close",
        F.timestamp_seconds("datetime").alias("_time"),
    ).withWatermark("_time", lateness)
    after, until = (F.expr(f"_at + INTERVAL {s} SECONDS") for s in (delay, span))
    near = (F.col("ticker") == F.col("_ticker")) & (F.col("_time") > after) & (F.col("_time") <= until)
    priced = left.join(right, near, "left_outer").groupBy("id", "ticker", "created", "_at").agg(
        F.min("datetime").alias("open_at"),
        F.min_by("open", "datetime").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "datetime").alias("close"),
    )
    return label_prices(priced, ["id", "ticker", "created"], "created", max_gap, threshold)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the recent triggers dropped because they came behind the watermark."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def state_rows(query: StreamingQuery) -> int:
    """Rows that the stateful operators hold after the last trigger."""
    last = query.lastProgress
    return sum(s["numRowsTotal"] for s in last["stateOperators"]) if last else 0


class _Newest(StatefulProcessor):
    """Rows newer than all rows of their key in earlier batches."""

    def __init__(self, time: str, start: int, keep_ms: int | None):
        self.time, self.start, self.keep_ms = time, start, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "latest long", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.latest.get()[0] if self.latest.exists() else self.start
        newest = known
        for batch in rows:
            fresh = batch[batch[self.time] > known]
            if len(fresh):
                newest = max(newest, int(fresh[self.time].max()))
                yield fresh
        if newest > known:
            self.latest.update((newest,))

    def close(self) -> None:
        pass


def fresh_stream(stream: DataFrame, key: str, time: str, start: int, keep: str | None = None) -> DataFrame:
    """Rows strictly newer, by whole-number ``time``, than what earlier batches had for their key.

    The newest time of each key is state that lasts across runs, so no run reads the target
    to find it; a key not seen before begins at ``start``. With ``keep`` (such as ``30 days``)
    a key that brings nothing new for so long is forgotten and begins at ``start`` again.
    Rows of a key within one batch are compared with earlier batches only. Rows without
    key or time are not newer than anything and do not pass. Set ``STATE_STORE`` to
    ``ROCKSDB`` before the stream starts.
    """
    keep_ms = None if keep is None else int(pd.Timedelta(keep).total_seconds() * 1000)
    rows = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_Newest(time, start, keep_ms), outputStructType=rows.schema,
        outputMode="Append", timeMode="None" if keep is None else "ProcessingTime",
    )
