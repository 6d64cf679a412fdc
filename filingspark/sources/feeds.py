"""JSON and CSV feeds to typed columns. Each takes rows of text or a path of landed files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingspark import schemas
from filingspark.functions import clean, dates
from filingspark.operators import keys
from filingspark.operators.flatten import unnest


def _parsed(df: DataFrame, content: str, schema: str, required: str | None = None) -> DataFrame:
    """The object in each row of text, as columns.

    The object passes through a one-element list. That keeps later filters and
    projections above the parser, which would otherwise run once for each.
    """
    parsed = F.array(F.from_json(content, schema))
    if required is not None:
        parsed = F.filter(parsed, lambda o: o[required].isNotNull())
    return df.select(F.inline(parsed))


def unreadable(df: DataFrame, content: str = "content") -> DataFrame:
    """The rows whose text is not JSON, to be stored as failures; the feeds below leave them out."""
    return df.where(F.try_parse_json(F.col(content)).isNull())


def _facts_schema(only: Mapping[str, Sequence[str]]) -> str:
    def concepts(names: Sequence[str]) -> str:
        listed = ",".join(f"`{n}`:{schemas.CONCEPT}" for n in names)
        return f"struct<{listed}>" if names else f"map<string,{schemas.CONCEPT}>"

    listed = ",".join(f"`{taxonomy}`:{concepts(names)}" for taxonomy, names in only.items())
    return f"cik string, facts struct<{listed}>"


def company_facts(
    df: DataFrame, content: str = "content", only: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """One row per company: padded cik and facts as nested maps. Objects without a cik drop out.

    ``only`` names the taxonomies to be read and their concepts (none: all of them), which
    then are structs; the parser passes over the others.
    """
    schema = schemas.COMPANY_FACTS if only is None else _facts_schema(only)
    parsed = _parsed(df, content, schema, required="cik")
    return parsed.withColumn("cik", clean.pad_cik(F.col("cik")))


def submissions(df: DataFrame, content: str = "content") -> DataFrame:
    """One row per company; overflow objects, which carry no cik, drop out."""
    parsed = _parsed(df, content, schemas.SUBMISSIONS, required="cik")
    return parsed.withColumn("cik", clean.pad_cik(F.col("cik")))


def ticker_list(df: DataFrame, content: str = "content") -> DataFrame:
    """The values of a ``{"0": {cik_str, ticker, title}}`` object, cik padded."""
    values = F.map_values(F.from_json(content, schemas.TICKER_LIST))
    return unnest(df, [], values).withColumn("cik_str", clean.pad_cik(F.col("cik_str")))


def screener_csv(spark: SparkSession, path: str) -> DataFrame:
    return screener(spark.read.csv(path, header=True))


def screener(df: DataFrame) -> DataFrame:
    """Screener rows; a blank market cap becomes -1 and decimal text is cut to whole."""
    cap = F.coalesce(F.col("Market Cap").try_cast("double"), F.lit(-1.0)).cast("bigint")
    return df.select(
        F.col("Symbol").alias("symbol"),
        cap.alias("market_cap"),
        F.col("Country").alias("country"),
        F.col("Sector").alias("sector"),
        F.col("Industry").alias("industry"),
    )


def news_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Landed article pages: a JSON list per file, or with ``lines`` one article per line."""
    return spark.read.schema(schemas.ARTICLE).json(path, multiLine=not lines)


def news_webhooks(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Landed webhook envelopes projected to article rows.

    A file holds one envelope over any number of lines, or a list of them; with
    ``lines`` there is one on each line. What carries no article drops out.
    """
    content = F.col("data.content")
    envelopes = spark.read.schema(schemas.WEBHOOK).json(path, multiLine=not lines)
    return envelopes.where("data.content.id is not null").select(
        F.col("id").alias("webhook_id"),
        "kind",
        F.col("data.action").alias("action"),
        content["id"].alias("id"),
        F.array_join(content["authors"], ", ").alias("author"),
        dates.epoch(content["created_at"]).alias("created"),
        dates.epoch(content["updated_at"]).alias("updated"),
        content["title"].alias("title"),
        content["teaser"].alias("teaser"),
        content["body"].alias("body"),
        content["url"].alias("url"),
        content["channels"].alias("channels"),
        content["securities"]["symbol"].alias("stocks"),
        content["tags"].alias("tags"),
    )


def apply_webhooks(articles: DataFrame, webhooks: DataFrame) -> DataFrame:
    """``articles`` after the events: the last one per id removes its article or replaces it.

    Both have ``id`` and ``updated``, ``webhooks`` also ``action``: Removed or Deleted
    takes the article out, any other action puts its row in place. Of one article's
    events the latest by ``updated`` counts.
    """
    columns = articles.columns
    last = keys.last_wins(webhooks.select(*columns, "action"), ["id"], ["updated"])
    kept = articles.join(last.select("id"), "id", "left_anti").select(*columns)
    gone = F.lower("action").isin("removed", "deleted")
    return kept.unionByName(last.where(~F.coalesce(gone, F.lit(False))).select(*columns))


def filing_bodies(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """The manifest's rows with ``rawContent``, the text of the landed file of that name.

    Files lie below ``path`` as ``<accessionNumber>/<filename>``. Only files named in the
    manifest whose extension contains ``htm`` are kept; rows without a landed file drop out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    parts = F.split("path", "/")
    landed = files.select(
        F.element_at(parts, -2).alias("accessionNumber"), F.element_at(parts, -1).alias("filename"),
        F.decode("content", "UTF-8").alias("rawContent"),
    )
    return htm_files(manifest).join(landed, ["accessionNumber", "filename"])


def price_history(df: DataFrame, content: str = "content") -> DataFrame:
    """Candle rows in epoch seconds; an empty reply gives no rows."""
    parsed = _parsed(df, content, schemas.PRICE_HISTORY)
    kept = F.when(~F.coalesce("empty", F.lit(False)), F.col("candles"))
    rows = unnest(parsed.withColumnRenamed("symbol", "ticker"), ["ticker"], kept)
    return rows.withColumn("datetime", F.floor(F.col("datetime") / 1000).cast("bigint"))


def market_hours(df: DataFrame, content: str = "content", day: str = "day") -> DataFrame:
    """Per requested day: whether equities trade, and the regular session in epoch seconds."""
    eq = F.from_json(content, schemas.MARKET_HOURS)["equity"]["EQ"]
    session = F.get(eq["sessionHours"]["regularMarket"], F.lit(0))
    return df.select(
        F.col(day),
        F.coalesce(eq["isOpen"], F.lit(False)).alias("is_open"),
        F.unix_timestamp(session["start"].try_cast("timestamp")).alias("start"),
        F.unix_timestamp(session["end"].try_cast("timestamp")).alias("end"),
    )


def htm_files(manifest: DataFrame, name: str = "filename") -> DataFrame:
    """Manifest rows whose file extension contains ``htm``."""
    return manifest.where(F.substring_index(name, ".", -1).contains("htm"))
