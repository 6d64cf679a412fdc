"""The corpus pipeline: language, near duplicates, mixture and packing over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as
Parquet to the shared folder and reads again as the next stage's ``docs``. All but the last
return the columns of ``documents``. No SQL can express the stages, so ``ORACLE_SQL`` is
None and the tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingspark.llm import language, mixing, packing, parity_join
from filingspark.llm.tables import stored, table

LEAST_SCORE = 0.4
BROADCAST_ROWS = 1_000_000
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language learnt from the labelled ones.

    Rejected: texts that are NULL or without letters, and those whose best language has a
    tempered posterior below ``LEAST_SCORE``, as texts in other languages do. Without any
    label nothing can be learnt, and no document stays.
    """
    labelled = docs.where(~language.held_out(F.col("doc_id"))).select("lang", "text")
    judged = language.identify(docs, language.learn(labelled))
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return judged.where(kept).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked texts: the one with the least id.

    A document is known by its id. Rows that share one count as one document: it goes
    if any of its texts is linked to a lesser id, and otherwise its least row stays.
    Rows without an id are never linked and stay.
    """
    found = stored(parity_join.components(docs), "components")
    known = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"), F.count("*").alias("rows")
    )
    moved = stored(known.where("component_id < doc_id or rows > 1"), "moved")
    drop = moved.select("doc_id")
    if moved.count() <= BROADCAST_ROWS:
        drop = F.broadcast(drop)  # at most BROADCAST_ROWS ids
    single = docs.join(drop, "doc_id", "left_anti")
    repeated = moved.where("component_id = doc_id")
    rest = [c for c in docs.columns if c != "doc_id"]
    least = (
        docs.join(repeated, "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min(F.struct(*rest)).alias("row"))
        .select("doc_id", "row.*")
        .select(*docs.columns)
    )
    return single.unionByName(least)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.

    A document of which the mix takes w words of s is repeated w / s times, rounded;
    documents that it does not take go. Rows that share id and source share their words.
    """
    taken = mixing.taken_rows(mixing.sized(docs))
    times = (
        taken.groupBy("doc_id", "source")
        .agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
        .where("size > 0")
        .select(
            F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
            F.round(F.col("taken") / F.col("size")).cast("int").alias("_times"),
        )
        .where("_times > 0")
    )
    same = docs["doc_id"].eqNullSafe(times["_id"]) & docs["source"].eqNullSafe(times["_source"])
    repeated = docs.join(times, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), times["_times"])))
    return repeated.select(*[docs[c] for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1,024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
