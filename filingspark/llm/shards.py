"""Operator 10: shards of near equal bytes by sampled splitters."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingspark.llm.tables import place, stored, task_count, weighted_splitters

SAMPLES_PER_RANGE = 32
OVERFULL = 2.0
ROUNDS = 4


def _drawn(records: DataFrame, rate: Column) -> list[tuple]:
    """A sample of keys with weights, each record drawn with a chance in proportion to its size.

    The draw hangs on the key alone, so reruns agree. What is collected is the
    sample, whose expected size is ranges x ``SAMPLES_PER_RANGE``.
    """
    chance = F.least(F.lit(1.0), rate * F.col("_size"))
    spun = (F.pmod(F.xxhash64(F.lit("draw"), "_k1", "_k2"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = records.where(spun < chance).select("_k1", "_k2", (F.col("_size") / chance).alias("w"))
    return sorted(((r["_k1"], r["_k2"]), r["w"]) for r in rows.collect())


def _range_of(bounds: list[tuple[int, int]]) -> Column:
    return place(
        F.struct("_k1", "_k2"),
        bounds,
        lambda b: F.struct(F.lit(b[0]).cast("long").alias("_k1"), F.lit(b[1]).cast("long").alias("_k2")),
    )


def _measured(records: DataFrame, bounds: list) -> list:
    """Exact bytes and counts of each range; at most ``len(bounds) + 1`` rows."""
    return (
        records.groupBy(_range_of(bounds).alias("range"))
        .agg(
            F.sum("_size").alias("bytes"), F.count("*").alias("n"), F.max("_size").alias("largest"),
            F.min(F.struct("_k1", "_k2")).alias("low"), F.max(F.struct("_k1", "_k2")).alias("high"),
        )
        .orderBy("range")
        .collect()
    )


def splitters(records: DataFrame, ranges: int) -> tuple[list, list]:
    """Range bounds over ``(_k1, _k2)`` and what each range holds.

    The first bounds are the weighted quantiles of a sample. Ranges that turn out
    to hold over ``OVERFULL`` times their share are sampled again, more densely,
    and cut further, unless they hold one key or one large record only.
    """
    total = records.agg(F.sum("_size")).first()[0] or 0
    if not total:
        return [], _measured(records, [])
    share = total / ranges
    rate = F.lit(SAMPLES_PER_RANGE / share)
    bounds = weighted_splitters(_drawn(records, rate), ranges)
    held = _measured(records, bounds)
    for step in range(1, ROUNDS):
        over = [
            r for r in held
            if r["bytes"] > OVERFULL * share and r["low"] != r["high"] and r["largest"] < r["bytes"] / 2
        ]
        if not over:
            break
        inside = records.where(_range_of(bounds).isin([r["range"] for r in over]))
        sample = _drawn(inside, rate * 4**step)
        cut = set(bounds)
        for r in over:
            low, high = tuple(r["low"]), tuple(r["high"])
            own = [x for x in sample if low <= x[0] <= high]
            cut.update(weighted_splitters(own, -int(-r["bytes"] // share)))
        bounds = sorted(cut)
        held = _measured(records, bounds)
    return bounds, held


def shard(records: DataFrame, key: Column, tie: Column, size: Column, shards: int) -> DataFrame:
    """Adds ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 within its shard).

    Records are ordered by the hashes of ``key`` and ``tie``. Splitters drawn from a
    size-weighted sample cut that order into ranges; ranges are summed exactly, and
    a record's shard follows from the bytes that lie before it. So every shard holds
    an equal share of the bytes, give or take one record, however rows fall: equal
    keys lie next to each other, and a key above a shard's share runs over several
    shards. A hot key is cut by ``tie`` like any range, so no task holds more than
    about ``OVERFULL`` times its share, save for rows equal in both.

    ``key`` and ``tie`` may be NULL (hashed like a value); ``size`` must be positive.
    An empty table gives no rows. Other columns pass through; the names starting
    with ``_`` in front of ``k1 k2 size range`` are taken.
    """
    keyed = records.withColumns(
        {
            "_k1": F.xxhash64(F.lit("key"), key),
            "_k2": F.xxhash64(F.lit("tie"), tie),
            "_size": size.cast("long"),
        }
    )
    ranges = max(16 * shards, task_count(records.sparkSession))
    bounds, held = splitters(keyed.select("_k1", "_k2", "_size"), ranges)
    filled = {r["range"]: (r["bytes"], r["n"]) for r in held}
    each = [filled.get(i, (0, 0)) for i in range(len(bounds) + 1)]
    before = list(accumulate((b for b, _ in each), initial=0))
    counted = list(accumulate((n for _, n in each), initial=0))
    total = before[-1] or 1

    def at(values: list[int], index: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), index + 1)

    order = Window.partitionBy("_range").orderBy("_k1", "_k2", "_size")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        keyed.withColumn("_range", _range_of(bounds))
        .withColumns(
            {
                "_start": at(before, F.col("_range")) + F.coalesce(F.sum("_size").over(so_far), F.lit(0)),
                "_rank": at(counted, F.col("_range")) + F.row_number().over(order) - 1,
            }
        )
        .withColumn(
            "shard",
            F.floor(F.col("_start").cast("decimal(38,0)") * shards / F.lit(total).cast("decimal(20,0)")).cast("int"),
        )
    )
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return (
        placed.join(F.broadcast(first), "shard")  # one row a shard
        .withColumn("slot", F.col("_rank") - F.col("_first"))
        .drop("_k1", "_k2", "_size", "_range", "_start", "_rank", "_first")
    )


def write_shards(sharded: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder per shard, rows in the order of their slots, in files of equal counts."""
    piece = F.pmod(F.col("slot"), F.lit(files_per_shard))
    sharded.repartition("shard", piece).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """The digest of documents in shards: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    A document weighs the UTF-8 bytes of its text (none if NULL) plus 8. Equal texts
    share a key, so they lie next to each other and are cut apart only where a shard
    ends. Only the digest travels; ``shard`` takes the texts along if they are in its
    rows.
    """
    digest = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    placed = shard(stored(digest, "digest"), F.col("text_hash"), F.col("doc_id"), F.col("size"), shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
