"""Joins around companies: known filers, stale keys, enrichment, dossiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingspark.functions import clean
from filingspark.operators.keys import first_wins, spread_join


def known_companies(df: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows whose cik is listed. A cik with several tickers does not repeat rows."""
    listed = symbols.select(clean.pad_cik(F.col("cik_str")).alias("cik")).distinct()
    return spread_join(df, listed, ["cik"], "left_semi")


def stale_keys(keys: DataFrame, df: DataFrame, key: str, time: str, since) -> DataFrame:
    """Keys without any row later than ``since``."""
    current = df.where(F.col(time) > since).select(key).distinct()
    return keys.select(key).distinct().join(current, key, "left_anti")


def unloaded_filings(filings: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Filings whose accession, written without dashes, has no artifact yet."""
    plain = F.replace("accessionNumber", F.lit("-"), F.lit(""))
    loaded = artifacts.select(plain.alias("_accession")).distinct()
    return (
        filings.withColumn("_accession", plain)
        .join(loaded, "_accession", "left_anti")
        .drop("_accession")
    )


def screener_enrich(
    features: DataFrame, screener: DataFrame, counts: DataFrame | None = None
) -> DataFrame:
    """Features with the screener columns of their ticker; rows without id are dropped."""
    unique = first_wins(screener, ["symbol"], ["market_cap", "country", "sector", "industry"], False)
    return spread_join(
        features.where("id IS NOT NULL"),
        unique.withColumnRenamed("symbol", "ticker"),
        ["ticker"],
        "left",
        spread_on=["id"],
        counts=counts,
    )


def resolve_company(symbols: DataFrame, name: str) -> DataFrame:
    """Companies whose title contains ``name``, case sensitive."""
    return symbols.where(F.col("title").contains(name)).select("cik_str", "title").distinct()


def _grams(text: Column, size: Column) -> Column:
    """The distinct substrings of ``size`` characters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda at: F.substr(text, at, size)))


def resolve_companies(
    symbols: DataFrame, names: DataFrame, name: str = "name", gram: int = 3, rows_per_task: int | None = None
) -> DataFrame:
    """``name, cik_str, title``: the companies whose title contains each of many names, case sensitive.

    A title that contains a name has all its substrings, so each name looks only at the
    titles that have its rarest one of ``gram`` characters (all of a shorter name), and a name
    with a substring that no title has is done. Titles that share a frequent substring
    are spread over tasks. NULL and empty names resolve to nothing.
    """
    asked = names.select(F.col(name).alias("name")).where("name <> ''").distinct()
    titles = symbols.select("title").where("title is not null").distinct()
    size = F.least(F.length("name"), F.lit(gram))
    sizes = F.sequence(F.lit(1), F.least(F.length("title"), F.lit(gram)))
    of_titles = titles.select(
        "title", F.explode(F.flatten(F.transform(sizes, lambda n: _grams(F.col("title"), n)))).alias("gram")
    )
    of_names = asked.select("name", F.explode(_grams(F.col("name"), size)).alias("gram"))
    wanted = of_names.select("gram").distinct()
    met = spread_join(of_titles, wanted, ["gram"], "left_semi", ["title"], rows_per_task)
    counts = met.groupBy("gram").agg(F.count("*").alias("_n"))
    rarest = (
        of_names.join(counts, "gram", "left").groupBy("name")
        .agg(F.min_by("gram", F.struct("_n", "gram")).alias("gram"), F.count_if(F.col("_n").isNull()).alias("absent"))
        .where("absent = 0").select("name", "gram")
    )
    near = spread_join(of_titles, rarest, ["gram"], "inner", ["title"], rows_per_task, counts)
    found = near.where(F.col("title").contains(F.col("name"))).select("name", "title")
    listed = symbols.select("title", "cik_str").distinct()
    return spread_join(listed, found, ["title"], "inner", ["cik_str"], rows_per_task).select("name", "cik_str", "title")


def resolved_ticker(tickers_json: Column) -> Column:
    """Letters of a JSON ticker list, run together."""
    return clean.letters_only(tickers_json)


def dossier(
    companies: DataFrame,
    meta: DataFrame,
    addresses: DataFrame,
    news: DataFrame,
    candles: DataFrame,
    filings: DataFrame,
    since: int,
    filed_since: int | None = None,
) -> DataFrame:
    """Everything known about ``companies`` (cik, ticker) as rows ``(cik, section, at, item)``.

    News, candles and filings are those after ``since`` (``filed_since`` for
    filings, where given). The sections are meta, address, news, candle and filing; ``at`` is the epoch
    second of the item or NULL. Items stay rows instead of growing lists, so a
    company with very many items does not end up in one cell.
    """
    wanted = companies.select("cik", "ticker").distinct()
    ciks, tickers = wanted.select("cik").distinct(), wanted

    def section(name: str, df: DataFrame, key: str, at: Column, fields: Sequence[Column]) -> DataFrame:
        picked = df.select(key, at.cast("bigint").alias("at"), F.to_json(F.struct(*fields)).alias("item"))
        owners = ciks if key == "cik" else tickers
        if name in ("meta", "address"):  # one row per company
            joined = picked.join(owners, key)
        else:
            joined = spread_join(picked, owners, [key], spread_on=["at", "item"])
        return joined.select("cik", F.lit(name).alias("section"), "at", "item")

    none = F.lit(None)
    filed = F.unix_timestamp(F.col("filingDate").cast("timestamp"))
    parts = [
        section("meta", meta, "cik", none, [F.col(c) for c in meta.columns]),
        section("address", addresses, "cik", none, [F.col(c) for c in addresses.columns]),
        section(
            "news", news.where(F.col("created") >= since), "ticker", F.col("created"),
            [F.col("id"), F.col("title")],
        ),
        section(
            "candle", candles.where(F.col("datetime") > since), "ticker", F.col("datetime"),
            [F.col(c) for c in ("open", "high", "low", "close", "volume")],
        ),
        section(
            "filing", filings.where(filed > (since if filed_since is None else filed_since)), "cik", filed,
            [clean.filing_link(F.col("cik"), F.col("accessionNumber"), F.col("primaryDocument")).alias("link")],
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def triples_resolved(triples: DataFrame, nodes: DataFrame) -> DataFrame:
    """Triples with text and label of both ends; ``nodes`` is unique by id."""
    sizes = {
        end: triples.where(F.col(end).isNotNull()).groupBy(end).agg(F.count("*").alias("_n"))
        for end in ("head_id", "tail_id")
    }
    out = triples
    for end in ("head", "tail"):
        named = nodes.select(
            F.col("id").alias(f"{end}_id"),
            F.col("text").alias(f"{end}_text"),
            F.col("label").alias(f"{end}_label"),
        )
        out = spread_join(out, named, [f"{end}_id"], counts=sizes[f"{end}_id"])
    return out
