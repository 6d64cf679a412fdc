"""Operator 5: Merkle trees over archive records, to find where replicas differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingspark.llm.tables import stored
from filingspark.llm.warc import block_is_sound, laid_out, record_text

LEAF_BYTES = 64 << 10
FAN = 4  # bits: each node has up to 16 children


def _height(most: int) -> int:
    """Levels of children above the addresses 0 to ``most`` until one node is left."""
    height = 0
    while most >> (FAN * height):
        height += 1
    return height


def trees(replicas: DataFrame) -> list[DataFrame]:
    """Levels of a Merkle tree per replica, leaves first: ``replica, address, hash, records``.

    ``replicas`` has ``replica, archive, offset, length, digest`` with archives numbered
    from 0. A leaf covers the records that start in one range of ``LEAF_BYTES`` of an
    archive, in the order of their offsets; ranges are aligned to offsets, so a lost
    record changes its own leaf only. An inner node covers 16 neighbouring ranges,
    the upper ones 16 archives, up to a single root. A group never has more than 16
    children, or, in a leaf, one entry per record start within the range; repeated
    rows are counted into one entry first.
    """
    most = replicas.agg(F.max("archive"), F.max(F.expr(f"offset div {LEAF_BYTES}L"))).first()
    archives, ranges = (most[0] or 0), (most[1] or 0)
    inside = FAN * _height(ranges)
    address = F.shiftleft(F.col("archive").cast("long"), inside) + F.expr(f"offset div {LEAF_BYTES}L")
    entries = (
        replicas.withColumn("address", address)
        .groupBy("replica", "address", "offset", "length", "digest")
        .agg(F.count("*").alias("n"))
    )
    listed = F.array_sort(F.collect_list(F.struct("offset", "length", "digest", "n")))
    level = stored(
        entries.groupBy("replica", "address").agg(
            F.sha2(F.to_json(listed), 256).alias("hash"), F.sum("n").alias("records")
        ),
        "leaves",
    )
    levels = [level]
    for _ in range(_height(archives << inside | ranges)):
        children = F.array_sort(F.collect_list(F.struct("address", "hash")))
        level = stored(
            level.groupBy("replica", F.shiftright("address", FAN).alias("parent"))
            .agg(F.sha2(F.to_json(children), 256).alias("hash"), F.sum("records").alias("records"))
            .withColumnRenamed("parent", "address"),
            "level",
        )
        levels.append(level)
    return levels


def mismatching(levels: list[DataFrame], names: list[str]) -> DataFrame:
    """Addresses of the leaves in which the replicas are not all alike.

    Roots are compared first; from there only the children of differing nodes are
    read against each other.
    """
    frontier = None
    for level in reversed(levels):
        if frontier is not None:
            parent = F.shiftright(level["address"], FAN)
            level = level.join(frontier, parent == frontier["parent"], "left_semi")
        alike = (F.count("*") == len(names)) & (F.min("hash") == F.max("hash"))
        differing = level.groupBy("address").agg(alike.alias("alike")).where("not alike")
        frontier = stored(differing.select(F.col("address").alias("parent")), "frontier")
    return frontier.withColumnRenamed("parent", "address")


def audit(replicas: DataFrame, names: list[str]) -> DataFrame:
    """``archive, offset, replica, fault, key, length, digest``: every record that is not as it should be.

    ``replicas`` has ``replica, archive, offset, length, digest, sound, key``. Only records
    of leaves that differ are looked at. ``missing``: the replica lacks a record that
    another has; ``corrupt``: its block has not the declared digest; ``odd``: it is sound
    but unlike the sound copy that most replicas hold (the least digest among equals).
    Records damaged alike in all replicas have equal trees and need the plain check of
    ``sound``. NULL archives or offsets are not allowed; an empty table has no faults.
    """
    replicas = stored(replicas, "replicas")
    levels = trees(replicas)
    bad = mismatching(levels, names)
    ranges = replicas.agg(F.max(F.expr(f"offset div {LEAF_BYTES}L"))).first()[0] or 0
    address = F.shiftleft(F.col("archive").cast("long"), FAN * _height(ranges)) + F.expr(f"offset div {LEAF_BYTES}L")
    suspect = replicas.withColumn("address", address).join(bad, "address", "left_semi").drop("address")
    place = ["archive", "offset"]
    votes = suspect.groupBy(*place, "digest").agg(
        F.countDistinct(F.when(F.col("sound"), F.col("replica"))).alias("n")
    )
    rank = F.row_number().over(Window.partitionBy(*place).orderBy(F.desc("n"), "digest"))
    best = votes.where("n > 0").withColumn("rank", rank).where("rank = 1").select(*place, F.col("digest").alias("best"))
    known = suspect.groupBy(*place).agg(F.min("key").alias("key"))
    every = known.withColumn("replica", F.explode(F.array(*[F.lit(n) for n in names])))
    held = suspect.select(*place, "replica", "length", "digest", "sound").distinct()
    joined = every.join(held, [*place, "replica"], "left").join(best, place, "left")
    fault = (
        F.when(F.col("digest").isNull(), "missing")
        .when(~F.col("sound"), "corrupt")
        .when(F.col("digest") != F.col("best"), "odd")
    )
    return joined.withColumn("fault", fault).where("fault is not null").select(
        *place, "replica", "fault", "key", "length", "digest"
    )


def flipped(text: Column) -> Column:
    """A text with its middle character changed."""
    at = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), at), F.lit("\x00"), F.substring(text, at + 2, F.length(text)))


def page_replicas(pages: DataFrame) -> DataFrame:
    """Three replicas of the WARC archives of ``pages``, two of them damaged by rules on ``page_id``.

    In replica b every 97th id (by checksum) has a changed character and every 103rd
    record is lost; in replica c every 101st is cut in half. A NULL id is never damaged.
    """
    spun = F.coalesce(F.crc32(F.col("page_id").cast("string")), F.lit(0))
    record = record_text(F.col("page_id"), F.col("url"), F.col("html"))
    half = F.substring(F.col("record"), F.lit(1), F.floor(F.length("record") / 2).cast("int"))
    forms = {
        "a": F.col("record"),
        "b": F.when(spun % 103 == 7, None).when(spun % 97 == 3, flipped(F.col("record"))).otherwise(F.col("record")),
        "c": F.when(spun % 101 == 5, half).otherwise(F.col("record")),
    }
    described = pages.select("page_id", record.alias("record")).select(
        "page_id",
        F.octet_length("record").cast("long").alias("length"),
        *[
            F.when(form.isNotNull(), F.struct(
                F.octet_length(form).cast("long").alias("length"), F.sha2(form, 256).alias("digest"),
                block_is_sound(form).alias("sound"),
            )).alias(name)
            for name, form in forms.items()
        ],
    )
    laid = stored(laid_out(described, "page_id", "length"), "laid")
    one = [
        laid.where(F.col(name).isNotNull()).select(
            F.lit(name).alias("replica"), "archive", "offset", f"{name}.*", F.col("page_id").alias("key")
        )
        for name in forms
    ]
    return reduce(DataFrame.unionByName, one)
