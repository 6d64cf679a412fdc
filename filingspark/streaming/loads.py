"""Incremental loads: landed files to tables, once per key, restartable."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from filingspark.operators import keys as K
from filingspark.operators.keys import spread_join

BUCKETS = 64
LAYOUT = ("buckets", "stream", "batch", "bucket")
OBJECTS_PER_FILE = 1_000_000
GROUP_BYTES = 4 << 20
SPLIT = "spark.sql.files.maxPartitionBytes"


def land(objects: DataFrame, path: str, per_file: int = OBJECTS_PER_FILE, mode: str = "overwrite") -> None:
    """Write objects for a file stream, at most ``per_file`` to a file, replacing earlier ones or after them.

    Row groups are small, so that a batch of few files is read by many tasks.
    """
    out = objects.write.mode(mode).option("maxRecordsPerFile", per_file)
    out.option("compression", "zstd").option("parquet.block.size", GROUP_BYTES).parquet(path)


def read_landed(
    spark: SparkSession,
    path: str,
    schema,
    files_per_trigger: int = 10,
    pattern: str | None = None,
    finished: str | None = None,
) -> DataFrame:
    """A file stream; ``finished`` is ``delete`` or a folder to move read files to."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if finished == "delete":
        reader = reader.option("cleanSource", "delete")
    elif finished:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", finished)
    return reader.parquet(path)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None where there is no such path or no file in it yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def insert_ignore_batches(
    target: str,
    keys: Sequence[str],
    order: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    stream: str = "0",
    buckets: int = BUCKETS,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends unseen keys to ``target``.

    Each batch of each ``stream`` owns a folder and replaces it, so a batch that is run
    again after a failure leaves the same rows, and two streams, or one that has lost its
    checkpoint, never write over each other's; name streams by ``stream_id``. Rows lie in
    folders by a hash of their key, and a batch reads the folders of its own keys only.
    Folders written with another number of buckets are read whole. A target that was
    written in some other way is read whole and appended to. The transformed batch is
    kept while it is loaded. Two streams that load the same new key at the same moment
    may both store it, as with any append without a lock.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = transform(batch).persist(StorageLevel.DISK_ONLY)
        try:
            stored = read_or_none(spark, target)
            owned = stored is None or set(LAYOUT) <= set(stored.columns)
            if stored is None:
                stored = spark.createDataFrame([], rows.schema)
            elif owned:
                touched = [r[0] for r in rows.select(_bucket(keys, buckets)).distinct().collect()]
                mine = (F.col("stream") == stream) & (F.col("batch") == batch_id)
                near = (F.col("buckets") != buckets) | F.col("bucket").isin(touched)
                stored = stored.where(near & ~mine).drop(*LAYOUT)
            # stored files are packed so tightly that their size is no measure of the keys: never broadcast
            new = K.insert_ignore(stored.hint("merge"), rows, keys, order)
            if owned:
                # a file for each bucket, not one for each task and bucket: every later batch lists them
                placed = new.withColumn("bucket", _bucket(keys, buckets)).hint("rebalance", F.col("bucket"))
                folder = f"{target}/buckets={buckets}/stream={stream}/batch={batch_id}"
                placed.write.mode("overwrite").partitionBy("bucket").parquet(folder)
            else:
                new.write.mode("append").parquet(target)
        finally:
            rows.unpersist()

    return load


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a table that ``insert_ignore_batches`` has written, without its layout."""
    return spark.read.parquet(target).drop(*LAYOUT)


@dataclass(frozen=True)
class Target:
    """A table to be filled from a feed: how its rows come from a batch, and their key."""

    rows: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    order: Sequence[str]


def load_tables(
    root: str,
    parse: Callable[[DataFrame], DataFrame],
    targets: Mapping[str, Target],
    stream: str = "0",
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that parses a batch once and fills every table below ``root``."""

    def load(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(batch).persist(StorageLevel.DISK_ONLY)
        try:
            for name, t in targets.items():
                insert_ignore_batches(f"{root}/{name}", t.keys, t.order, t.rows, stream)(parsed, batch_id)
        finally:
            parsed.unpersist()

    return load


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """A name for the stream of a checkpoint, kept beside it; a new checkpoint gets a new one."""
    path = f"{checkpoint.rstrip('/')}-id"
    known = read_or_none(spark, path)
    if known is None:
        spark.createDataFrame([(uuid.uuid4().hex,)], "id string").write.mode("ignore").parquet(path)
        known = spark.read.parquet(path)
    return known.first()["id"]


def run_available(stream: DataFrame, checkpoint: str, load: Callable) -> StreamingQuery:
    """Process everything that has landed, then stop; offsets live in ``checkpoint``.

    Meanwhile files are read in parts of ``GROUP_BYTES``: landed text is packed tightly, and the
    parser's work is spread over all cores.
    """
    conf = stream.sparkSession.conf
    before = conf.get(SPLIT)
    conf.set(SPLIT, str(GROUP_BYTES))
    try:
        query = (
            stream.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        conf.set(SPLIT, before)
    return query


def run_append(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("compression", "zstd")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def dedupe_stream(
    stream: DataFrame, keys: Sequence[str], time: str | None = None, within: str | None = None
) -> DataFrame:
    """First row per key across the stream; a time column and span bound the state."""
    if time is None:
        return stream.dropDuplicates(list(keys))
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, within)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def skip_loaded(batch: DataFrame, stored: DataFrame, key: str = "accn") -> DataFrame:
    """Rows whose filing is not stored yet."""
    return spread_join(batch, stored.select(key).distinct(), [key], "left_anti")


def fresh_rows(df: DataFrame, watermarks: DataFrame, key: str, time: str) -> DataFrame:
    """Rows strictly newer than the ``latest`` of their key."""
    return (
        spread_join(df, watermarks.select(key, "latest"), [key])
        .where(F.col(time) > F.col("latest"))
        .drop("latest")
    )


def stream_backlog(query: StreamingQuery) -> list[dict]:
    """Rows read and processing rate of the recent triggers."""
    return [
        {"batch": p["batchId"], "rows": p["numInputRows"], "rate": p.get("processedRowsPerSecond")}
        for p in query.recentProgress
    ]
