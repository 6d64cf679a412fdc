"""Reading the tables, cutting lineage and placing keys among splitters."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingspark.session import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again; cuts the lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def place(key: Column, bounds: Sequence, literal=F.lit) -> Column:
    """How many of the sorted ``bounds`` are at or below ``key``, in two steps of root size.

    A NULL key is above all bounds.
    """
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds) - 1) + 1
    runs = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    first = F.array(*[literal(run[0]) for run in runs])
    coarse = F.size(F.filter(first, lambda b: b <= key))
    nested = F.array(*[F.array(*[literal(b) for b in run]) for run in runs])
    fine = F.size(F.filter(F.element_at(nested, F.greatest(coarse, F.lit(1))), lambda b: b <= key))
    return (
        F.when(key.isNull(), F.lit(len(bounds)))
        .when(coarse == 0, F.lit(0))
        .otherwise((coarse - 1) * step + fine)
    )


def weighted_splitters(sample: Sequence[tuple], parts: int) -> list:
    """Keys that cut the sorted ``(key, weight)`` sample into ``parts`` of equal weight."""
    total = sum(weight for _, weight in sample)
    keys, sums, so_far = [], [], 0.0
    for key, weight in sample:
        keys.append(key)
        sums.append(so_far)
        so_far += weight
    at = [bisect_left(sums, total * part / parts) for part in range(1, parts)]
    return sorted({keys[i] for i in at if 0 < i < len(keys)})
