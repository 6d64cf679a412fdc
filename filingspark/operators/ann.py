"""Approximate vector search: random-projection hash tables, probed from the nearest bucket on."""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingspark.functions.vectors import METRICS, score_all

TABLES = 8
ROWS_PER_BUCKET = 32
MOST_BITS = 24
CELL_BITS = 5
PROBES = 256
SEED = 11


def planes(dimensions: int, tables: int, bits: int, seed: int = SEED) -> np.ndarray:
    """``tables x bits`` random directions, the same for the same arguments."""
    return np.random.default_rng([seed, dimensions, tables, bits]).standard_normal((tables, bits, dimensions))


def _signatures(directions: np.ndarray):
    tables, bits, dimensions = directions.shape
    flat = directions.reshape(tables * bits, dimensions).T
    powers = 1 << np.arange(bits, dtype=np.int64)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            sizes = column.value_lengths()
            fits = np.array(pc.fill_null(pc.equal(sizes, dimensions), False), dtype=bool)
            rows = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)  # NULL is not finite
            rows = rows.astype(np.float64).reshape(-1, dimensions)
            found = np.zeros((len(column), tables), dtype=np.int64)
            found[fits] = ((rows @ flat) >= 0).reshape(-1, tables, bits) @ powers
            fits[fits] = np.isfinite(rows).all(axis=1)
            values = pa.array(found[fits].ravel())
            ends = np.cumsum(np.where(fits, tables, 0))
            yield pa.ListArray.from_arrays(
                pa.array(np.append(0, ends), pa.int32()), values, mask=pa.array(~fits)
            )

    return run


@dataclass(frozen=True)
class Index:
    """Where an index lies and how it was made."""

    path: str
    vector: str
    key: str
    dimensions: int
    tables: int
    bits: int
    seed: int
    columns: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(T.StructType.fromJson(json.loads(self.columns))).parquet(f"{self.path}/rows")

    def counts(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("bucket long, n long, table int").parquet(f"{self.path}/counts")

    @property
    def cell_bits(self) -> int:
        return min(self.bits, CELL_BITS)

    def directions(self) -> np.ndarray:
        return planes(self.dimensions, self.tables, self.bits, self.seed)


def build_index(
    vectors: DataFrame,
    path: str,
    key: str,
    vector: str,
    fields: Sequence[str] = (),
    tables: int = TABLES,
    bits: int | None = None,
    seed: int = SEED,
) -> Index:
    """Write the hash tables of ``vectors`` below ``path``, replacing an earlier index.

    In each of ``tables`` tables a row lies in the bucket that the signs of ``bits`` random
    projections name; by default there is a bucket for every ``ROWS_PER_BUCKET`` rows. A
    table holds the vectors and ``fields`` themselves, so a search reads its buckets and
    nothing else. Rows are sorted by bucket within folders of buckets, and a folder is
    written by as many tasks as its size needs, however full a bucket is. Rows without a
    finite vector of the common length cannot be found and are not indexed.
    """
    spark = vectors.sparkSession
    count, dimensions = vectors.where(F.col(vector).isNotNull()).agg(
        F.count("*"), F.max(F.size(vector))
    ).first()
    dimensions = dimensions or 1
    if bits is None:
        bits = max(1, min(MOST_BITS, math.ceil(math.log2(max(1, count) / ROWS_PER_BUCKET)) if count else 1))
    found = F.arrow_udf(_signatures(planes(dimensions, tables, bits, seed)), "array<long>")
    rows = vectors.select(key, *fields, F.col(vector).cast("array<float>").alias(vector)).withColumn("_found", found(vector))
    placed = rows.select(key, *fields, vector, F.posexplode("_found").alias("table", "bucket")).withColumn(
        "cell", F.shiftright("bucket", bits - min(bits, CELL_BITS)).cast("int")
    )
    index = Index(path, vector, key, dimensions, tables, bits, seed, placed.schema.json())
    dealt = placed.hint("rebalance", F.col("table"), F.col("cell")).sortWithinPartitions("table", "cell", "bucket", key)
    dealt.write.mode("overwrite").partitionBy("table", "cell").parquet(f"{path}/rows")
    counts = index.rows(spark).groupBy("table", "bucket").agg(F.count("*").alias("n"))
    counts.hint("rebalance", F.col("table")).sortWithinPartitions("bucket").write.mode("overwrite").partitionBy(
        "table").parquet(f"{path}/counts")
    about = spark.createDataFrame(
        [(vector, key, dimensions, tables, bits, seed, index.columns)],
        "vector string, key string, dimensions int, tables int, bits int, seed long, columns string",
    )
    about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    return index


def open_index(spark: SparkSession, path: str) -> Index:
    return Index(path, **spark.read.parquet(f"{path}/about").first().asDict())


def probes(index: Index, query: Sequence[float], most: int = PROBES) -> list[tuple[int, int, float]]:
    """``(table, bucket, cost)``: in each table the query's own bucket and those next to it.

    A bucket that differs in some signs costs the squared distances of the query from the
    planes between them; buckets come in ascending cost.
    """
    directions = index.directions()
    unit = np.asarray(query, dtype=np.float64)
    unit = unit / (np.linalg.norm(unit) or 1.0)
    most, found = min(most, 1 << index.bits), []
    for table, rows in enumerate(directions):
        margin = rows @ unit
        own = int(((margin >= 0) * (1 << np.arange(index.bits))).sum())
        price = (margin / np.linalg.norm(rows, axis=1)) ** 2
        order = np.argsort(price, kind="stable")
        price = price[order]
        found.append((table, own, 0.0))
        heap, taken = [(float(price[0]), 0, 1 << int(order[0]))], 1
        while heap and taken < most:  # the next best set of signs grows from one already taken
            cost, last, flips = heapq.heappop(heap)
            found.append((table, own ^ flips, cost))
            taken += 1
            if last + 1 < index.bits:
                bit, before = 1 << int(order[last + 1]), 1 << int(order[last])
                heapq.heappush(heap, (cost + float(price[last + 1]), last + 1, flips | bit))
                heapq.heappush(heap, (cost + float(price[last + 1] - price[last]), last + 1, flips ^ before | bit))
    return found


def knn_lsh(
    spark: SparkSession,
    index: Index,
    queries: Mapping[str, Sequence[float]],
    k: int,
    num_candidates: int,
    fields: Sequence[str] = (),
    metric: str = "COSINE",
    where: Column | None = None,
    most_probes: int = PROBES,
) -> DataFrame:
    """About the ``k`` best rows per query vector: ``(query, rank, key, score, fields)``.

    Buckets are taken from the nearest on until they hold ``num_candidates`` rows that
    satisfy ``where`` (columns of the index), a row counting once per hash table it is met
    in; at most ``most_probes`` buckets of a table. All rows of the buckets taken are
    scored exactly. Only their folders and row groups are read, and each task passes on
    its own best rows of each query, so what is shuffled depends on the number of
    candidates and not of rows. ``similarity.knn`` is the exact search.
    """
    wanted = [
        (name, number, table, bucket, cost)
        for number, (name, query) in enumerate(queries.items())
        for table, bucket, cost in probes(index, query, most_probes)
    ]
    asked = spark.createDataFrame(wanted, "query string, number int, table int, bucket long, cost double")
    rows = _buckets(index.rows(spark), index, wanted)
    if where is None:
        counts = index.counts(spark)
    else:
        rows = rows.where(where)
        counts = rows.groupBy("table", "bucket").agg(F.count("*").alias("n"))
    nearest = Window.partitionBy("query").orderBy("cost", "table", "bucket")
    before = F.sum("n").over(nearest.rowsBetween(Window.unboundedPreceding, -1))
    taken = (  # at most tables x most_probes rows for each query vector
        counts.join(F.broadcast(asked), ["table", "bucket"]).withColumn("before", F.coalesce(before, F.lit(0)))
        .where(F.col("before") < num_candidates).select("query", "number", "table", "bucket").collect()
    )
    chosen = spark.createDataFrame(taken, "query string, number int, table int, bucket long")
    hits = (
        _buckets(rows, index, [(r["query"], r["number"], r["table"], r["bucket"], 0.0) for r in taken])
        .withColumn("_scores", score_all(F.col(index.vector), list(queries.values()), metric))
        .join(F.broadcast(chosen), ["table", "bucket"])
        .select("query", index.key, *fields, F.get("_scores", F.col("number")).alias("score"))
    )
    best = F.desc_nulls_last("score") if METRICS[metric][1] else F.asc_nulls_last("score")
    order = Window.partitionBy("query").orderBy(best, F.asc(index.key))
    copies = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k * index.tables)
    single = copies.drop("rank").dropDuplicates(["query", index.key])
    ranked = single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query", "rank", index.key, "score", *fields)


def _buckets(rows: DataFrame, index: Index, wanted: Sequence[tuple]) -> DataFrame:
    """The rows of the buckets named, by conditions that reach the folders and the files."""
    if not wanted:
        return rows.where(F.lit(False))
    buckets = sorted({w[3] for w in wanted})
    cells = sorted({b >> (index.bits - index.cell_bits) for b in buckets})
    return rows.where(F.col("cell").isin(cells) & F.col("bucket").isin(buckets))
