"""Nested company and article records to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingspark import schemas
from filingspark.functions import clean, dates


def _concept(taxonomy: str, name: str) -> Column:
    return F.col("facts").getItem(taxonomy).getItem(name)["units"]


def unnest(df: DataFrame, leading: Sequence[str], entries: Column) -> DataFrame:
    """One row per struct in the array ``entries``, its fields next to ``leading``.

    The outer form with a check of the position keeps the optimizer from adding
    a size filter, which would be pushed below and parse the JSON a second time.
    """
    rows = df.select(*leading, F.posexplode_outer(entries).alias("_pos", "_entry"))
    return rows.where("_pos IS NOT NULL").select(*leading, "_entry.*")


def unnest_map(df: DataFrame, leading: Sequence[str], entries: Column, key: str, value: str) -> DataFrame:
    """One row per entry of a map; see ``unnest`` for the outer form."""
    rows = df.select(*leading, F.explode_outer(entries).alias(key, value))
    return rows.where(F.col(key).isNotNull())


def _observations(df: DataFrame, leading: Sequence[str], observations: Column) -> DataFrame:
    rows = unnest(df, leading, observations)
    return rows.withColumns(
        {
            "val": clean.safe_long(F.col("val")),
            "fy": F.coalesce("fy", F.lit(0)),
            "frame": F.coalesce("frame", F.lit("")),
            "start": F.col("start").try_cast("date"),
            "end": F.col("end").try_cast("date"),
            "filed": F.col("filed").try_cast("date"),
        }
    )


# What ``feeds.company_facts`` has to read for each of the tables below.
SHARES_ONLY = {"dei": ["EntityCommonStockSharesOutstanding"]}
FLOAT_ONLY = {"dei": ["EntityPublicFloat"]}
ACCOUNTING_ONLY: dict[str, list[str]] = {"us-gaap": []}


def shares_outstanding(facts: DataFrame) -> DataFrame:
    units = _concept("dei", "EntityCommonStockSharesOutstanding")
    return _observations(facts, ["cik"], units.getItem("shares")).drop("start")


def public_float(facts: DataFrame) -> DataFrame:
    """Public float in the currency listed first."""
    entries = F.map_entries(_concept("dei", "EntityPublicFloat"))
    first = facts.select("cik", F.get(entries, F.lit(0)).alias("_first"))
    first = first.select("cik", F.col("_first.key").alias("currency"), F.col("_first.value").alias("obs"))
    return _observations(first, ["cik", "currency"], F.col("obs")).drop("start")


def accounting_facts(
    facts: DataFrame,
    taxonomies: Sequence[str] = ("us-gaap",),
    units: Sequence[str] | None = None,
) -> DataFrame:
    """Every observation of every concept and unit.

    ``units`` keeps, per concept, only the first listed unit that is present.
    """
    kind = facts.schema["facts"].dataType
    if isinstance(kind, T.StructType):  # read with ``only``
        named = [F.struct(F.lit(n).alias("taxonomy"), F.col("facts")[n].alias("concepts")) for n in kind.names]
        by_taxonomy = facts.select("cik", F.inline(F.array(*named)))
    else:
        by_taxonomy = unnest_map(facts, ["cik"], F.col("facts"), "taxonomy", "concepts")
    by_type = unnest_map(
        by_taxonomy.where(F.col("taxonomy").isin(*taxonomies)),
        ["cik", "taxonomy"], F.col("concepts"), "type", "concept",
    )
    per_unit = F.col("concept.units")
    if units is not None:
        kept = F.get(
            F.filter(F.array(*[F.lit(u) for u in units]), lambda u: F.map_contains_key(per_unit, u)),
            F.lit(0),
        )
        per_unit = F.map_filter(per_unit, lambda name, _: name == kept)
    leading = ["cik", "taxonomy", "type"]
    by_unit = unnest_map(by_type, leading, per_unit, "unit", "obs")
    return _observations(by_unit, [*leading, "unit"], F.col("obs"))


def filings(submissions: DataFrame) -> DataFrame:
    """One row per filing from the parallel arrays of ``filings.recent``; a missing array is NULLs."""
    arrays = [
        F.coalesce(
            f"filings.recent.{c}", F.array().cast(f"array<{schemas.FILING_TYPES.get(c, 'string')}>")
        ).alias(c)
        for c in schemas.FILING_COLUMNS
    ]
    rows = unnest(submissions, ["cik"], F.arrays_zip(*arrays))
    return rows.withColumns(
        {
            "filingDate": F.col("filingDate").try_cast("date"),
            "reportDate": F.col("reportDate").try_cast("date"),
            "acceptanceDateTime": F.col("acceptanceDateTime").try_cast("timestamp"),
            "isXBRL": F.col("isXBRL").cast("boolean"),
            "isInlineXBRL": F.col("isInlineXBRL").cast("boolean"),
        }
    )


def addresses(submissions: DataFrame) -> DataFrame:
    """Two rows per company, ``kind`` being mailing or business."""
    kinds = [
        F.struct(
            F.lit(kind).alias("kind"),
            *[F.col(f"addresses.{kind}.{c}").alias(c) for c in schemas.ADDRESS_COLUMNS],
        )
        for kind in ("mailing", "business")
    ]
    return unnest(submissions, ["cik"], F.array(*kinds))


def company_meta(submissions: DataFrame) -> DataFrame:
    """The scalar columns, with lists as JSON text."""
    lists = [F.to_json(c).alias(c) for c in ("tickers", "exchanges", "formerNames")]
    plain = ["cik", *schemas.COMPANY_TEXT_COLUMNS, *schemas.COMPANY_FLAG_COLUMNS]
    return submissions.select(*plain, *lists)


def normalise_articles(articles: DataFrame) -> DataFrame:
    """Drop url and image, dates to epoch seconds, named lists to lists of names."""
    names = {c: F.transform(c, lambda x: x["name"]) for c in ("channels", "stocks", "tags")}
    return articles.drop("url", "image").withColumns(
        {"created": dates.epoch(F.col("created")), "updated": dates.epoch(F.col("updated")), **names}
    )


def article_children(articles: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """One row per listed child: ``(id, kind, pos, name)``."""
    listed = [F.struct(F.lit(k).alias("kind"), F.col(k).alias("names")) for k in kinds]
    lists = articles.select("id", F.inline(F.array(*listed)))
    return lists.select("id", "kind", F.posexplode("names").alias("pos", "name"))


def article_images(articles: DataFrame) -> DataFrame:
    return articles.select("id", F.posexplode("image").alias("pos", "_image")).select(
        "id", "pos", "_image.size", "_image.url"
    )
