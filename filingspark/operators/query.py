"""Parametric reads: filters, projections, ordering and paging over any table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COMPARE = {"eq": "__eq__", "gt": "__gt__", "lt": "__lt__"}
DISPLAY = {
    "headline": ["id", "created", "updated", "author", "title"],
    "abstract": ["id", "created", "updated", "author", "title", "teaser"],
    "full": ["id", "created", "updated", "author", "title", "teaser", "body"],
}

# The filing types of interest, in the spelling left by strip_specials.
TARGET_FILINGS = [
    "10-Q", "10-K", "8-K", "6-K", "FORM 4", "DEF 14A", "FORM 3", "S-4", "S-8", "40F", "424A",
    "424B", "SC 13DA", "20-F", "10-QA", "11-K",
]


def _listed(value: Any) -> list:
    return list(value) if isinstance(value, (list, tuple)) else [value]


def table_query(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    where: Sequence[tuple[str, str, Any]] = (),
    distinct: bool | str = False,
    sort: str | Sequence[str] | None = None,
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Projection of the rows meeting every ``(column, eq|gt|lt, value)`` condition.

    Any value but None filters, zero and the empty string included. Sorting
    applies with or without conditions; ``sort`` may name columns outside the
    projection unless ``distinct`` is asked for. ``distinct`` may name a column:
    then one row stays for each of its values, the least by the projected columns.
    """
    for name, compare, value in where:
        if value is not None:
            df = df.where(getattr(F.col(name), _COMPARE[compare])(F.lit(value)))
    if distinct:
        df = df.select(*columns) if columns else df
    if isinstance(distinct, str):
        rest = [c for c in df.columns if c != distinct]
        least = F.min(F.struct(*rest) if rest else F.lit(0)).alias("_row")
        df = df.groupBy(distinct).agg(least).select(*[c if c == distinct else f"_row.{c}" for c in df.columns])
    elif distinct:
        df = df.distinct()
    if sort is not None:
        df = df.orderBy(*[F.desc(c) if descending else F.asc(c) for c in _listed(sort)])
    if limit is not None:
        df = df.limit(limit)
    return df.select(*columns) if columns and not distinct else df


def unique_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def point_lookup(df: DataFrame, key: str, value: Any) -> DataFrame:
    return df.where(F.col(key) == F.lit(value)).limit(1)


def ticker_search(
    articles: DataFrame,
    ticker: str,
    key: str | None = None,
    condition: str = "lte",
    value: Any = None,
    limit: int | None = None,
) -> DataFrame:
    """A ticker's articles, newest first; ``eq`` with a pair is an inclusive range."""
    hits = articles.where(F.col("ticker") == ticker)
    if key is not None:
        bounds = _listed(value)
        low = {"gte": bounds[0], "eq": bounds[0]}.get(condition)
        high = {"lte": bounds[0], "eq": bounds[-1]}.get(condition)
        if low is not None:
            hits = hits.where(F.col(key) >= F.lit(low))
        if high is not None:
            hits = hits.where(F.col(key) <= F.lit(high))
    hits = hits.orderBy(F.desc("created"), F.asc("id"))
    return hits if limit is None else hits.limit(limit)


def _topic_rank(topics: Sequence[str]) -> Column:
    """1 when a topic is in the title, 2 in the tags, 3 in the body, else NULL."""
    words = [t.lower() for t in topics]

    def found(text: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.lower(text).contains(w) for w in words])

    return (
        F.when(found(F.col("title")), 1)
        .when(F.exists("tags", found), 2)
        .when(found(F.col("body")), 3)
    )


def news_feed(
    articles: DataFrame,
    display: str = "headline",
    date_from: int | None = None,
    date_to: int | None = None,
    updated_since: int | None = None,
    published_since: int | None = None,
    sort: str | None = None,
    tickers: Sequence[str] | None = None,
    identifiers: Mapping[str, Sequence[str]] | None = None,
    channels: Sequence[str] | None = None,
    topics: Sequence[str] | None = None,
    authors: Sequence[str] | None = None,
    content_types: Sequence[str] | None = None,
    page: int | None = None,
    page_size: int = 100,
) -> DataFrame:
    """The news request contract over an article table.

    Times are epoch seconds, both date bounds inclusive. Topics match title,
    tags, then body, and order the result by that priority unless ``sort`` is
    given. ``identifiers`` maps a security id column (isin, cusip) to its
    values. ``page`` counts from 0; without it every article is returned.
    """
    if page is not None and page < 0:
        raise ValueError("page counts from 0")

    def overlaps(column: str, values: Sequence[str]) -> Column:
        return F.arrays_overlap(F.col(column), F.array(*[F.lit(v) for v in values]))

    conditions = [
        (date_from, lambda v: F.col("created") >= v),
        (date_to, lambda v: F.col("created") <= v),
        (published_since, lambda v: F.col("created") >= v),
        (updated_since, lambda v: F.col("updated") >= v),
        (tickers, lambda v: overlaps("stocks", v)),
        (channels, lambda v: overlaps("channels", v)),
        (authors, lambda v: F.col("author").isin(*v)),
        (content_types, lambda v: F.col("content_type").isin(*v)),
    ]
    for value, condition in conditions:
        if value is not None:
            articles = articles.where(condition(value))
    for column, values in (identifiers or {}).items():
        articles = articles.where(F.col(column).isin(*values))
    order: list[Column] = []
    if topics is not None:
        articles = articles.withColumn("_rank", _topic_rank(topics)).where("_rank IS NOT NULL")
        order = [] if sort else [F.asc("_rank")]
    field, direction = (sort or "created:desc").split(":")
    order += [F.asc(field) if direction == "asc" else F.desc(field), F.asc("id")]
    if page is not None:
        articles = articles.orderBy(*order).offset(page * page_size).limit(page_size)
    elif sort is not None:
        articles = articles.orderBy(*order)
    return articles.select(*DISPLAY[display])


def paged_query(
    df: DataFrame,
    condition: str,
    columns: Sequence[str],
    order: Sequence[str],
    offset: int = 0,
    limit: int | None = None,
    partitions: tuple[str, Sequence[Any]] | None = None,
) -> DataFrame:
    """SQL condition, optional partition list, then a window of the total ``order``.

    With a ``limit`` each task passes on no more rows than the window reaches to. An
    ``offset`` alone would number the whole table in one task and is refused.
    """
    if offset and limit is None:
        raise ValueError("an offset needs a limit")
    if partitions is not None:
        df = df.where(F.col(partitions[0]).isin(*partitions[1]))
    df = df.where(F.expr(condition)).orderBy(*order)
    return (df if limit is None else df.offset(offset).limit(limit)).select(*columns)


def focused_articles(articles: DataFrame, most: int = 3) -> DataFrame:
    """Articles whose ticker is among their own stocks and that name few of them."""
    return articles.where(F.array_contains("stocks", F.col("ticker")) & (F.size("stocks") <= most))


def filing_types(
    filings: DataFrame,
    types: Sequence[str] = tuple(TARGET_FILINGS),
    column: str = "form",
    limit: int | None = None,
) -> DataFrame:
    df = filings.where(F.col(column).isin(*types))
    return df if limit is None else df.limit(limit)


def nonempty(df: DataFrame, content: str) -> DataFrame:
    """Rows whose cleaned content, a list, has at least one entry."""
    return df.where(F.size(content) > 0)


def price_history(candles: DataFrame, ticker: str) -> DataFrame:
    return candles.where(F.col("ticker") == ticker)
