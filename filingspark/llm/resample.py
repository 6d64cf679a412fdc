"""Operator 11: importance resampling towards a target, with n-gram buckets from prefix CRCs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingspark.llm import crc
from filingspark.llm.memory import tidy
from filingspark.llm.shingles import slices
from filingspark.llm.tables import stored, task_count

LONGEST = 2
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
TEXT_BYTES = 1 << 20
BLANK = 0x20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _opens(data: np.ndarray) -> np.ndarray:
    """Where words begin in one text."""
    word = _WORD[_LOWER[data]]
    word[1:] &= ~word[:-1]
    return np.flatnonzero(word)


def windows(texts: pa.Array, longest: int, most: int = TEXT_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """``(first row, bytes, offsets, known)``: whole texts together, or a window of one long text.

    Windows of a long text end between words and share ``longest - 1`` words; ``known`` of
    the leading words have been counted by the window before. Memory is bounded by the
    window and the longest single word.
    """
    for first, last, data, offsets in slices(texts, most):
        if last - first > 1 or offsets[-1] - offsets[0] <= most:
            yield first, data[offsets[0] : offsets[-1]], offsets - offsets[0], 0
            continue
        at, stop, known = int(offsets[0]), int(offsets[-1]), 0
        while at < stop:
            end = min(at + most, stop)
            while end < stop and _WORD[_LOWER[data[end]]]:
                near = min(end + most, stop)
                gap = np.flatnonzero(~_WORD[_LOWER[data[end:near]]])
                end = end + int(gap[0]) if len(gap) else near
            part = data[at:end]
            yield first, part, np.array([0, len(part)]), known
            if end == stop:
                break
            opens = _opens(part)
            kept = min(longest - 1, len(opens))
            if len(opens) > kept > 0:
                at, known = at + int(opens[-kept]), kept
            else:  # too few new words to move on: all of them are carried, or there are none
                at, known = (at + int(opens[0]) if kept else end), kept
                if kept and end - at >= most:
                    most *= 2


def grams(data: np.ndarray, offsets: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Where each text's words begin, and for 1 to ``longest`` words the CRC of the run that ends at each word.

    The texts are scanned once, as their words in lower case with one blank behind each.
    A run's CRC follows from the running CRCs before and behind it. The second array of
    a pair tells which words end a run within their text.
    """
    low = _LOWER[data]
    word = _WORD[low]
    opens, stops = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    opens[inner] = word[inner]
    stops[inner - 1] = word[inner - 1]
    start = np.flatnonzero(opens)
    at = np.searchsorted(start, offsets)
    length = np.flatnonzero(stops) + 1 - start
    begin = np.cumsum(length + 1) - length - 1
    if not len(start):
        return at, [(np.zeros(0, np.uint32), np.zeros(0, bool))] * longest
    joined = np.full(int(begin[-1] + length[-1] + 1), BLANK, dtype=np.uint8)
    joined[np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)] = low[word]
    end = begin + length
    after = crc.Running(joined).at(end)
    before = np.append(np.uint32(0), crc.followed(after[:-1], BLANK))
    place = np.arange(len(start)) - np.repeat(at[:-1], np.diff(at))
    found = []
    for size in range(1, longest + 1):
        back = max(0, len(start) - size + 1)
        value = np.zeros(len(start), dtype=np.uint32)
        value[size - 1 :] = crc.span(before[:back], after[size - 1 :], end[size - 1 :] - begin[:back])
        found.append((value, place >= size - 1))
    return at, found


def _counted(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, data, offsets, known in windows(batch.column("text"), longest):
                for value, valid in grams(data, offsets, longest)[1]:
                    total += np.bincount(value[known:][valid[known:]] % buckets, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many features of all ``text`` rows fall in each bucket; at most ``buckets`` rows.

    Features are all runs of 1 to ``longest`` words, repeats counted; a NULL or empty
    text has none. Each task sends its own sums only.
    """
    parts = texts.select("text").mapInArrow(tidy(_counted(longest, buckets)), "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, gain`` of all buckets: the smoothed log ratio of target to source, in thousandths, floored."""
    every = source.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    both = (
        every.join(source.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .na.fill(0, ["s", "t"])
    )
    whole = source.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_s")).crossJoin(
        target.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_t"))
    )  # one row
    s, t, all_s, all_t = (F.col(c).cast("double") for c in ("s", "t", "all_s", "all_t"))
    ratio = ((t + 1) * (all_s + buckets)) / ((s + 1) * (all_t + buckets))
    return both.crossJoin(F.broadcast(whole)).select(
        "bucket", F.floor(F.log(ratio) * 1000).alias("gain")
    )


def _weighed(gain: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, total = np.zeros((3, batch.num_rows), dtype=np.int64)
            for first, data, offsets, known in windows(batch.column("text"), longest):
                at, found = grams(data, offsets, longest)
                rows = slice(first, first + len(at) - 1)
                fresh = np.maximum(at, known)
                words[rows] += np.diff(fresh)
                for value, valid in found:
                    worth = np.append(0, np.cumsum(np.where(valid, gain[value % len(gain)], 0)))
                    count = np.append(0, np.cumsum(valid))
                    total[rows] += worth[fresh[1:]] - worth[fresh[:-1]]
                    features[rows] += count[fresh[1:]] - count[fresh[:-1]]
            weight = total // np.maximum(features, 1)
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(words), pa.array(features), pa.array(weight)],
                names=[*names, "n_words", "n_features", "weight"],
            )

    return run


def weights(docs: DataFrame, gain: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain of each text's features, 0 without any.

    ``gain`` has one row per bucket, so what travels with the tasks is ``buckets`` numbers.
    """
    table = np.zeros(buckets, dtype=np.int64)
    for bucket, value in gain.select("bucket", "gain").collect():
        table[bucket] = value
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        tidy(_weighed(table, longest)), f"doc_id {kind}, n_words long, n_features long, weight long"
    )


def scored(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """With ``score``: weight and Gumbel noise in thousandths, drawn from a hash of seed and ``doc_id``.

    Rows without an id are hashed as if it were empty; rows that share one share its noise.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weighed.withColumn("score", F.col("weight") + noise)


def draw(rows: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """With ``rank``: 1, 2, 3 … by falling score for the drawn share of rows of enough words, else NULL.

    Ties go to the lesser ``doc_id`` (NULL last), then to the lesser weight and fewer
    features. Rows are range-partitioned by that order and numbered by the counts of the
    ranges before, so neither equal scores nor repeated ids meet in one task.
    """
    spark = rows.sparkSession
    order = [
        F.col("fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features"),
    ]
    rows = stored(rows.withColumn("fit", F.col("n_words") >= least_words), "scored")
    sorted_rows = rows.repartitionByRange(task_count(spark), *order).sortWithinPartitions(*order)
    placed = stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    parts = placed.groupBy("part").agg(F.count("*").alias("n"), F.count(F.when(F.col("fit"), 1)).alias("fit_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = parts.select(
        "part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.floor(F.sum("fit_n").over(everything) * percent / 100).alias("drawn"),
    )
    rank = F.col("before") + F.col("at") + 1
    return placed.join(F.broadcast(before), "part").select(  # one row for each shuffle partition
        "doc_id", "n_words", "n_features", "weight", "score", F.when(rank <= F.col("drawn"), rank).alias("rank")
    )


def resample(
    docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """Every row of ``docs`` by ``doc_id`` with its weight, score and, if drawn, rank.

    ``docs`` are drawn so that their word runs come near those of ``target``. NULL and empty
    texts have no words, weight 0 and are never drawn; repeated rows count and are drawn each
    for itself; an empty table gives no rows, an empty target only smooths; other columns
    than ``doc_id`` and ``text`` are not read.
    """
    # read twice each, at most ``buckets`` rows
    source, wanted = (stored(bucket_counts(t, longest, buckets), "counts") for t in (docs, target))
    gain = gains(source, wanted, buckets)
    return draw(scored(weights(docs, gain, longest, buckets), seed), least_words, percent)
