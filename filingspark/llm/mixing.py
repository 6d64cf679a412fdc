"""Operator 8: a low-discrepancy schedule that mixes sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingspark.llm.tables import stored

BLOCK_WORDS = 256
CHUNK = 1 << 16
CELLS = 4096
GOLDEN = (5**0.5 - 1) / 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0))


def source_targets(
    sizes: DataFrame, weights: Sequence[float], most: int, share: float = 1.0
) -> DataFrame:
    """One row per source: ``source_no, source, source_size, target``.

    Sources in code point order, NULL last, take ``weights`` in turn and share
    ``share`` of all words. A target stops at ``most`` times its source's size;
    the excess goes to the others by weight. With the sources sorted by the level
    at which they stop, the level of the rest follows from two running sums. The
    windows without a key run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    named = per.withColumn("source_no", F.row_number().over(by_name) - 1).withColumns(
        {
            "_w": F.element_at(turn, F.col("source_no") % len(weights) + 1),
            "_cap": F.col("source_size").cast("double") * most,
            "_all": F.sum("source_size").over(everything) * F.lit(float(share)),
        }
    )
    by_stop = Window.orderBy(F.col("_cap") / F.col("_w"), "source_no")
    lower = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_all") - F.coalesce(F.sum("_cap").over(lower), F.lit(0.0))
    weight = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(lower), F.lit(0.0))
    levelled = named.withColumns({"_rank": F.row_number().over(by_stop), "_level": left / weight})
    free = F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.struct("_rank", "_level"))
    level = F.min(free).over(everything)["_level"]
    target = F.least(F.col("_cap"), F.coalesce(level * F.col("_w"), F.col("_cap")))
    return levelled.select("source_no", "source", "source_size", target.alias("target"))


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """Slots ``slot, source_no, rank``: which source is drawn, and which of its blocks.

    Every source has as many slots as blocks in its target. The i-th point is
    i times the golden ratio modulo 1, on the grid of all slots: a step coprime to
    their number next to the golden section visits each grid point once, so the
    sources get their exact counts and any stretch of slots comes near them. Points
    meet the cumulative weights through cells of the grid, an equi join.
    """
    spark = sources.sparkSession
    counts = sources.select(
        "source_no", F.ceil(F.round("target").cast("long") / F.lit(block)).cast("long").alias("slots")
    ).where("slots > 0")
    running = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    ends = stored(counts.withColumn("hi", F.sum("slots").over(running)), "schedule")
    total, known = ends.agg(F.sum("slots"), F.count("*")).first()
    total = total or 0
    step = max(1, round(total * GOLDEN))
    while total and gcd(step, total) > 1:
        step += 1
    width = max(1, total // max(CELLS, 4 * known))
    cells = ends.withColumn("lo", F.col("hi") - F.col("slots")).withColumn(
        "cell", F.explode(F.sequence(F.expr(f"lo div {width}L"), F.expr(f"(hi - 1) div {width}L")))
    )
    point = F.pmod(
        F.col("slot").cast("decimal(19,0)") * F.lit(step).cast("decimal(19,0)"),
        F.lit(total or 1).cast("decimal(38,0)"),
    ).cast("long")
    points = spark.range(total).select(F.col("id").alias("slot")).withColumn("point", point)
    drawn = (
        points.withColumn("cell", F.expr(f"point div {width}L"))
        .join(cells, "cell")
        .where("point >= lo and point < hi")
        .select("slot", "source_no", F.expr(f"slot div {CHUNK}L").alias("chunk"))
    )
    own = Window.partitionBy("source_no", "chunk").orderBy("slot")
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = drawn.groupBy("source_no", "chunk").agg(F.count("*").alias("_n")).select(
        "source_no", "chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        drawn.withColumn("_own", F.row_number().over(own) - 1)
        .join(offsets, ["source_no", "chunk"])
        .select("slot", "source_no", (F.col("_before") + F.col("_own")).alias("rank"))
    )


def shuffled(sizes: DataFrame, seed: str) -> DataFrame:
    """Adds ``start``: the words of the same source before this document, in shuffled order.

    The order is that of a digest of ``doc_id``; its first digits deal each source
    over 4,096 runs, so a hot source is summed in many tasks.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    dealt = sizes.withColumn("_h", digest).withColumn("_run", F.substring("_h", 1, 3))
    inside = (
        Window.partitionBy("source_no", "_run")
        .orderBy("_h", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = Window.partitionBy("source_no").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = dealt.groupBy("source_no", "_run").agg(F.sum("size").alias("_n")).select(
        "source_no", "_run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        dealt.withColumn("_own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(runs, ["source_no", "_run"])
        .withColumn("start", F.col("_before") + F.col("_own"))
        .drop("_h", "_run", "_before", "_own")
    )


def blocks(placed: DataFrame, block: int) -> DataFrame:
    """Rows ``source_no, rank, ..., words``: the words that each block takes from a document.

    The shuffled words of a source, repeated as often as its target asks, are cut
    into blocks of ``block`` words. Adds ``epoch`` and ``rank``; a document that no
    block meets keeps one row with NULL in both.
    """
    wanted = F.round("target").cast("long")
    size, whole = F.col("size"), F.col("source_size")
    rounds = F.when(
        (size > 0) & (wanted > F.col("start")),
        F.sequence(F.lit(0).cast("long"), F.floor((wanted - F.col("start") - 1) / whole)),
    )
    repeated = placed.withColumn("epoch", F.explode_outer(rounds)).withColumns(
        {
            "_from": F.col("start") + F.col("epoch") * whole,
            "_to": F.least(F.col("start") + F.col("epoch") * whole + size, wanted),
        }
    )
    cut = repeated.withColumn(
        "rank", F.explode_outer(F.sequence(F.expr(f"_from div {block}L"), F.expr(f"(_to - 1) div {block}L")))
    )
    words = F.least("_to", (F.col("rank") + 1) * block) - F.greatest("_from", F.col("rank") * block)
    return cut.withColumn("words", words).drop("_from", "_to")


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def mix(
    sizes: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: int = 3,
    share: float = 1.0,
    block: int = BLOCK_WORDS,
    seed: str = "mix",
) -> tuple[DataFrame, DataFrame]:
    """``(taken, order)`` for rows ``doc_id, source, size``.

    ``order`` is the mix itself: ``slot, doc_id, source, epoch, words``, the words
    that each slot of the schedule takes from a document. ``taken`` has one row per
    input row: ``doc_id, source, size, source_size, target, taken``. Each source
    gives exactly its rounded target, and no document more than ``most`` times its
    size. NULL sources form a source of their own; documents without words take no
    part; an empty table gives no rows. Repeated rows count each for itself.
    """
    sizes = stored(sizes, "sizes")
    sources = stored(source_targets(sizes, weights, most, share), "sources")
    numbered = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    placed = stored(shuffled(numbered, seed), "placed")
    slots = schedule(sources, block)
    met = blocks(placed, block).join(slots, ["source_no", "rank"], "left")
    order = met.where("slot is not null").select("slot", "doc_id", "source", "epoch", "words")
    row = ["doc_id", "source_no", "start", "size", "source", "source_size", "target"]
    gone = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("words"))), F.lit(0)).cast("long")
    taken = met.where("size > 0").groupBy(*row).agg(gone.alias("taken"))
    wordless = placed.where("size = 0").select(*row, F.lit(0).cast("long").alias("taken"))
    return taken.unionByName(wordless), order


def taken_rows(sizes: DataFrame, **options) -> DataFrame:
    """The mix as ``doc_id, source, size, source_size, target, taken``, a row per input row."""
    taken, _ = mix(sizes, **options)
    return taken.select("doc_id", "source", "size", "source_size", "target", "taken")
