"""Parquet tables changed by key: only touched buckets are written anew, and a version is switched at once."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingspark.operators import keys as K

BUCKETS = 64


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    where, files = _store(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def _publish(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it; fails if ``path`` exists by then."""
    folder, _, name = path.rpartition("/")
    draft, files = _store(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    final = hadoop.Path(path)
    none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(draft), context.makeQualified(final), none)


@dataclass(frozen=True)
class Versioned:
    """A table whose rows lie in folders by a hash of their key.

    ``live/<n>.json`` lists for version ``n`` which write holds each bucket; the greatest
    number is the table. A change reads and writes the buckets of its own keys only, in a
    folder of its own, and then adds the next list by one rename. So a reader sees the
    old or the new rows, a job that ends early changes nothing, and of two changes that
    start from the same version the second fails instead of undoing the first. Earlier
    versions stay readable until ``forget``.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int
    schema: T.StructType

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        found = [int(n[:-5]) for n in _names(self.spark, f"{self.path}/live") if n.endswith(".json") and n[:-5].isdigit()]
        return max(found, default=0)

    def _live(self, version: int) -> dict[int, str]:
        """The write that holds each bucket: at most ``buckets`` rows."""
        if not version:
            return {}
        lines = self.spark.read.schema("bucket int, write string").json(f"{self.path}/live/{version}.json").collect()
        return {r["bucket"]: r["write"] for r in lines if r["bucket"] is not None}

    def _read(self, live: dict[int, str]) -> DataFrame:
        paths = [f"{self.path}/data/_write={w}/_bucket={b}" for b, w in sorted(live.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        stored = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*paths)
        return stored.select(*self.schema.names)

    def rows(self, version: int | None = None) -> DataFrame:
        return self._read(self._live(self.version() if version is None else version))

    def _change(self, touched: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame]) -> None:
        version = self.version()
        live = self._live(version)
        hit = {r[0] for r in touched(self._read(live)).select(self._bucket()).distinct().collect()}
        if not hit:
            return
        write = uuid.uuid4().hex
        changed = change(self._read({b: w for b, w in live.items() if b in hit}))
        placed = changed.select(*self.schema.names).withColumn("_bucket", self._bucket())
        folder = f"{self.path}/data/_write={write}"
        placed.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(folder)
        kept = {b: w for b, w in live.items() if b not in hit}
        kept |= {int(n.partition("=")[2]): write for n in _names(self.spark, folder) if n.startswith("_bucket=")}
        lines = [json.dumps({"bucket": b, "write": w}) for b, w in sorted(kept.items())] or ["{}"]
        _publish(self.spark, f"{self.path}/live/{version + 1}.json", "\n".join(lines))

    def upsert(self, batch: DataFrame, order: Sequence[str]) -> None:
        """Write ``batch`` over the rows of the same keys, its last row of a key winning."""
        self._change(lambda _: batch, lambda stored: K.upsert(stored, batch.select(*self.schema.names), self.keys, order))

    def delete_ids(self, ids: DataFrame) -> None:
        """Drop the rows whose key is in ``ids``."""
        listed = ids.select(*self.keys).distinct()
        self._change(
            lambda stored: listed, lambda stored: stored.join(listed, list(self.keys), "left_anti")
        )

    def delete_where(self, condition: Column) -> None:
        """Drop the rows for which ``condition`` is true; buckets without such a row stay as they are."""
        self._change(lambda stored: stored.where(condition), lambda stored: K.delete_where(stored, condition))

    def forget(self, keep: int = 1) -> None:
        """Remove all but the last ``keep`` versions and the buckets that only they had."""
        version = self.version()
        used = {pair for v in range(max(1, version - keep + 1), version + 1) for pair in self._live(v).items()}
        writes = {w for _, w in used}
        gone = [
            f"live/{name}" for name in _names(self.spark, f"{self.path}/live")
            if name.endswith(".json") and name[:-5].isdigit() and int(name[:-5]) <= version - keep
        ]
        for name in _names(self.spark, f"{self.path}/data"):
            write = name.partition("=")[2]
            inner = _names(self.spark, f"{self.path}/data/{name}") if write in writes else []
            stale = [n for n in inner if n.startswith("_bucket=") and (int(n.partition("=")[2]), write) not in used]
            gone += [f"data/{name}/{n}" for n in stale] if write in writes else [f"data/{name}"]
        for name in gone:
            where, files = _store(self.spark, f"{self.path}/{name}")
            files.delete(where, True)


def create(rows: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> Versioned:
    """A new table of ``rows`` at ``path``, their last row of a key winning by all other columns."""
    spark = rows.sparkSession
    about = [(list(keys), buckets, rows.schema.json())]
    spark.createDataFrame(about, "keys array<string>, buckets int, columns string").coalesce(1).write.parquet(f"{path}/about")
    _store(spark, f"{path}/live")[1].mkdirs(_store(spark, f"{path}/live")[0])
    table = open_table(spark, path)
    table.upsert(rows, [c for c in rows.columns if c not in keys])
    return table


def open_table(spark: SparkSession, path: str) -> Versioned:
    about = spark.read.parquet(f"{path}/about").first()
    return Versioned(spark, path, tuple(about["keys"]), about["buckets"], T.StructType.fromJson(json.loads(about["columns"])))
