"""Timestamps: parsing, formatting and calendar parts, always in an explicit zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK_S = 7 * 24 * 3600


def epoch(text: Column) -> Column:
    """Epoch seconds of RFC 2822, ISO date or date-time, US date-time, or bare epoch text in seconds or milliseconds.

    Weekday names cannot be parsed by pattern and carry no information, so they
    are removed. Unreadable text gives NULL.
    """
    body = F.regexp_replace(text, r"^\w+, ", "")
    parsed = F.coalesce(
        F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(body, F.lit("MM/dd/yyyy hh:mm a")),
        text.try_cast("timestamp"),
    )
    whole = seconds(text.try_cast("bigint"))
    return F.when(text.rlike(r"^\d{9,}$"), whole).otherwise(F.unix_timestamp(parsed))


def seconds(value: Column) -> Column:
    """Epoch seconds from seconds or, above ten digits, milliseconds."""
    whole = value.cast("bigint")
    return F.when(whole > 9_999_999_999, F.floor(whole / 1000).cast("bigint")).otherwise(whole)


def _local(epoch_s: Column, tz: str) -> Column:
    instant = F.timestamp_seconds(epoch_s)
    return F.convert_timezone(F.current_timezone(), F.lit(tz), instant.cast("timestamp_ntz"))


def format_epoch(value: Column, pattern: str = "yyyy-MM-dd", tz: str = "UTC") -> Column:
    return F.date_format(_local(seconds(value), tz), pattern)


def minute_of_day(epoch_s: Column, tz: str = "UTC") -> Column:
    """Seconds since local midnight, floored to the minute."""
    local = _local(epoch_s, tz)
    return F.hour(local) * 3600 + F.minute(local) * 60


def day_of_week(epoch_s: Column, tz: str = "UTC") -> Column:
    """Monday is 0 and Sunday 6."""
    return F.weekday(_local(epoch_s, tz))


def backfill_edges(start: Column, now: Column) -> Column:
    """Ascending edges of near-equal blocks of at least a week that cover start to now."""
    span = now - start
    weeks = F.floor(span / WEEK_S)
    step = F.floor(span / F.greatest(weeks, F.lit(1)))
    return F.when(span < WEEK_S, F.array(start, now)).otherwise(
        F.array_append(F.sequence(start, now, F.greatest(step, F.lit(1)).cast("bigint")), now)
    )
