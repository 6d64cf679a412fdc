"""Counters, freshness figures, histograms and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def type_frequency(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, the most frequent first; ``top`` keeps that many values."""
    counts = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(column))
    return counts if top is None else counts.limit(top)


def freshness(df: DataFrame, key: str, fresh: Column) -> DataFrame:
    """One row: distinct keys, and distinct keys with at least one fresh row.

    Rows collapse to one per key before the count, so both figures take a single
    shuffle of already combined rows.
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(fresh).alias("_fresh"))
    return per_key.agg(
        F.count("*").alias("total"), F.count_if(F.coalesce("_fresh", F.lit(False))).alias("fresh")
    )


def ticker_freshness(candles: DataFrame, since: int) -> DataFrame:
    return freshness(candles, "ticker", F.col("datetime") > since)


def filer_freshness(filings: DataFrame, as_of: Column, days: int = 1) -> DataFrame:
    return freshness(filings, "cik", F.col("filingDate") > F.date_sub(as_of, days))


def doc_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def high_watermark(keys: DataFrame, df: DataFrame, key: str, time: str, default: int) -> DataFrame:
    """Latest ``time`` per key of ``keys``, or ``default`` where there is none yet."""
    latest = df.groupBy(key).agg(F.max(time).alias("latest"))
    return (
        keys.select(key).distinct().join(latest, key, "left")
        .select(key, F.coalesce("latest", F.lit(default)).alias("latest"))
    )


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed, empty ones kept.

    A constant column gets a range of width one around its value, and a column
    of NULLs has no bins.
    """
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).where("x IS NOT NULL")
    limits = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n")))
    span = limits.scalar()
    flat = span["lo"] == span["hi"]
    low = F.when(flat, span["lo"] - 0.5).otherwise(span["lo"])
    width = F.when(flat, 1.0).otherwise(span["hi"] - span["lo"]) / bins
    at = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    n = F.coalesce("n", F.lit(0))
    return (
        every.join(counts, "bin", "left")
        .select(
            "bin",
            (low + F.col("bin") * width).alias("lower"),
            (low + (F.col("bin") + 1) * width).alias("upper"),
            n.alias("n"),
            (100.0 * n / span["n"]).alias("percent"),
        )
        .where("lower IS NOT NULL")
    )


def duplicate_ids(df: DataFrame, group: str, key: str) -> DataFrame:
    return df.groupBy(group, key).agg(F.count("*").alias("n")).where("n >= 2")


def backlog(offsets: DataFrame, topic: str = "topic") -> DataFrame:
    """Unread messages per topic from the low and high offset of its partitions."""
    return offsets.groupBy(topic).agg(F.sum(F.col("high") - F.col("low")).alias("backlog"))


def group_members(groups: DataFrame, group_id: int | None = None) -> DataFrame:
    """Size per group, or the rows of one group."""
    if group_id is not None:
        return groups.where(F.col("group_id") == group_id)
    return groups.where("group_id IS NOT NULL").groupBy("group_id").agg(F.count("*").alias("n"))


def label_counts(features: DataFrame) -> DataFrame:
    """Positive, neutral and negative counts per label column; zero counts are shown."""
    names = ["max_gain_24", "day_gain_24", "max_loss_24"]
    classes = {2: "positive", 1: "neutral", 0: "negative"}
    one_pass = features.agg(
        *[F.count_if(F.col(n) == v).alias(f"{n}_{v}") for n in names for v in classes]
    )
    cells = [
        F.struct(
            F.lit(n).alias("horizon"), F.lit(c).alias("label"), F.col(f"{n}_{v}").alias("n")
        )
        for n in names
        for v, c in classes.items()
    ]
    return one_pass.select(F.inline(F.array(*cells)))


def labelled(features: DataFrame, horizon: str, label: int) -> DataFrame:
    """The rows of one class of one label column."""
    return features.where(F.col(horizon) == label)
