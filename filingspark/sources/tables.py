"""Parquet tables: typed creation, append, insert-ignore, snapshot and failure routing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingspark import schemas
from filingspark.operators import keys as K
from filingspark.operators.similarity import embed_with
from filingspark.operators.text import CHUNK_SIZE, chunk_fixed
from filingspark.streaming.loads import read_or_none


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schemas.TABLES[table])


def create_tables(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> None:
    """Create every declared table that does not exist yet, with no rows."""
    for name in names or list(schemas.TABLES):
        empty(spark, name).write.mode("ignore").parquet(f"{root}/{name}")


def describe_tables(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """Rows ``(table, position, column, type)`` as stored."""
    rows = [
        (name, i, field.name, field.dataType.simpleString())
        for name in names
        for i, field in enumerate(spark.read.parquet(f"{root}/{name}").schema.fields)
    ]
    return spark.createDataFrame(rows, "table string, position int, column string, type string")


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings are NULL in a bulk load."""
    return df.withColumns(
        {n: F.when(F.col(n) != "", F.col(n)) for n, t in df.dtypes if t == "string"}
    )


def append(df: DataFrame, path: str) -> None:
    """All-or-nothing append: the job commit publishes every file or none."""
    blank_to_null(df).write.mode("append").parquet(path)


def _bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key), buckets).cast("int")


def write_clustered(
    df: DataFrame,
    path: str,
    key: str = "cik",
    sort: Sequence[str] = (),
    buckets: int = 256,
) -> None:
    """Write with a folder per hash bucket of ``key``, rows sorted by key within files.

    Tasks are cut by size as the plan runs, so a company with very many rows is
    written by several and small buckets share one. The number of buckets is stored
    with the rows. A rerun replaces the table.
    """
    rows = df.withColumns({"buckets": F.lit(buckets), "bucket": _bucket(F.col(key), F.lit(buckets))})
    dealt = rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", key, *sort)
    dealt.write.mode("overwrite").partitionBy("buckets", "bucket").parquet(path)


def read_clustered(spark: SparkSession, path: str, key: str, values: Sequence[str]) -> DataFrame:
    """The rows of a few keys, read from their buckets only."""
    own = [F.col("bucket") == _bucket(F.lit(v), F.col("buckets")) for v in values]
    wanted = reduce(lambda a, b: a | b, own, F.lit(False))
    return spark.read.parquet(path).where(wanted & F.col(key).isin(*values)).drop("buckets", "bucket")


def insert_ignore_into(
    batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]
) -> None:
    """Append the rows of ``batch`` whose key is neither stored nor seen earlier in it."""
    stored = read_or_none(batch.sparkSession, path)
    if stored is None:
        stored = batch.sparkSession.createDataFrame([], batch.schema)
    K.insert_ignore(stored, batch, keys, order).write.mode("append").parquet(path)


def vectorise_into(
    documents: DataFrame, key: str, text: str, path: str, load: Callable, size: int = CHUNK_SIZE
) -> None:
    """Chunk the documents not stored yet, embed the chunks and append them to ``path``.

    ``load`` makes the encoder, once per task; blank chunks are not embedded. A document
    is stored with all its chunks in one commit, so its key tells whether it is done.
    """
    done = read_or_none(documents.sparkSession, path)
    if done is not None:
        documents = documents.join(done.select(key).distinct(), key, "left_anti")
    chunks = chunk_fixed(documents, key, text, size).where(F.col("content").rlike(r"\S"))
    embedded = embed_with(chunks, "content", load).withColumnRenamed("embedding", "content_vector")
    embedded.write.mode("append").parquet(path)


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Store ``df`` whole and hand back the stored copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def enrich(
    df: DataFrame, fields: Sequence[str], encode: Callable[[list[str]], list[list[float]]]
) -> DataFrame:
    """Add ``<field>_embedding`` for each field and ``error``, NULL where all went well.

    The batch is encoded at once; only if that fails is each row tried alone, so
    one bad row costs no other row its result.
    """
    added = [T.StructField(f"{f}_embedding", T.ArrayType(T.FloatType())) for f in fields]
    schema = T.StructType([*df.schema.fields, *added, T.StructField("error", T.StringType())])

    def one(texts: list[str]) -> tuple[list[list[float]] | None, str | None]:
        try:
            return encode(texts), None
        except Exception as problem:  # the message is the routed result
            return None, str(problem)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.copy()
            errors: list[str | None] = [None] * len(batch)
            for field in fields:
                texts = batch[field].tolist()
                vectors, problem = one(texts)
                if problem is not None:
                    alone = [one([text]) for text in texts]
                    vectors = [v[0] if v else None for v, _ in alone]
                    errors = [old or new for old, (_, new) in zip(errors, alone)]
                out[f"{field}_embedding"] = pd.Series(vectors, index=out.index, dtype=object)
            out["error"] = pd.Series(errors, index=out.index, dtype=object)
            yield out

    return df.mapInPandas(run, schema)


def route_failures(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good rows and the failed rows (with their error message)."""
    return enriched.where("error IS NULL").drop("error"), enriched.where("error IS NOT NULL")


def reindex(
    source: str,
    destination: str,
    spark: SparkSession,
    fields: Sequence[str],
    encode: Callable[[list[str]], list[list[float]]],
) -> None:
    """Enrich a stored table into ``destination``, failures into ``destination-failed``."""
    spark_rows = enrich(spark.read.parquet(source), fields, encode)
    staged = f"{destination}-all"
    spark_rows.write.mode("overwrite").parquet(staged)  # the encoder runs once, not per branch
    good, failed = route_failures(spark.read.parquet(staged))
    good.write.mode("overwrite").parquet(destination)
    failed.write.mode("overwrite").parquet(f"{destination}-failed")
