from __future__ import annotations

from pyspark.sql import functions as F

from filingspark.streaming import loads

SCHEMA = "k int, v string, seq bigint"


def land(spark, path, start, n):
    rows = spark.range(start, start + n).select(
        (F.col("id") % 7).cast("int").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.col("id").alias("seq")
    )
    rows.coalesce(1).write.mode("append").parquet(path)


def test_stream_first_wins_and_restart(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land(spark, source, 0, 5)
    load = loads.insert_ignore_batches(target, ["k"], ["seq"])
    loads.run_available(loads.read_landed(spark, source, SCHEMA, 1), state, load)
    land(spark, source, 5, 50)
    loads.run_available(loads.read_landed(spark, source, SCHEMA, 1), state, load)
    stored = {r.k: r.seq for r in spark.read.parquet(target).collect()}
    assert stored == {k: k for k in range(7)}
    loads.run_available(loads.read_landed(spark, source, SCHEMA, 1), state, load)
    assert spark.read.parquet(target).count() == 7


def test_batch_can_run_again(spark, tmp_path):
    target = str(tmp_path / "out")
    load = loads.insert_ignore_batches(target, ["k"], ["seq"])
    batch = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], SCHEMA)
    load(batch, 0)
    load(batch, 0)  # the same batch after a failure
    load(batch, 1)  # the same rows in a later batch
    with_null = spark.createDataFrame([(None, "n", 1), (2, "late", 9)], SCHEMA)
    load(with_null, 2)
    load(with_null, 2)
    assert sorted(r.v for r in loads.loaded(spark, target).collect()) == ["a", "c", "n"]
    load(batch.limit(0), 2)  # the folder of a batch holds its last run only
    assert sorted(r.v for r in spark.read.parquet(target).collect()) == ["a", "c"]


def test_two_feeds_keep_all_rows(spark, tmp_path):
    target = str(tmp_path / "out")
    rows = {"a": range(10), "b": range(8, 15)}
    for name, ids in rows.items():
        state = str(tmp_path / f"state-{name}")
        own = loads.stream_id(spark, state)
        assert own == loads.stream_id(spark, state)
        load = loads.insert_ignore_batches(target, ["k"], ["seq"], stream=own)
        load(spark.createDataFrame([(i, name, i) for i in ids], SCHEMA), 0)
    stored = {r.k: r.v for r in loads.loaded(spark, target).collect()}
    assert stored == {i: "a" if i < 10 else "b" for i in range(15)}


def test_other_layouts_are_read(spark, tmp_path):
    plain, other = str(tmp_path / "plain"), str(tmp_path / "other")
    batch = spark.createDataFrame([(1, "a", 1), (2, "c", 3)], SCHEMA)
    batch.limit(1).write.parquet(plain)
    loads.insert_ignore_batches(plain, ["k"], ["seq"])(batch, 0)
    assert spark.read.parquet(plain).count() == 2
    loads.insert_ignore_batches(other, ["k"], ["seq"], stream="x", buckets=3)(batch, 0)
    loads.insert_ignore_batches(other, ["k"], ["seq"], stream="y", buckets=5)(batch, 0)
    assert loads.loaded(spark, other).count() == 2


def test_only_touched_buckets_are_read(spark, tmp_path):
    target = str(tmp_path / "out")
    load = loads.insert_ignore_batches(target, ["k"], ["seq"])
    load(spark.createDataFrame([(i, "a", i) for i in range(200)], SCHEMA), 0)
    touched = spark.read.parquet(target).where(loads._bucket(["k"], loads.BUCKETS) == F.col("bucket"))
    assert touched.count() == 200


def test_dedupe_stream(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land(spark, source, 0, 20)
    land(spark, source, 0, 20)
    stream = loads.dedupe_stream(loads.read_landed(spark, source, SCHEMA, 1).select("k"), ["k"])
    query = loads.run_append(stream, target, state)
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == list(range(7))
    assert sum(b["rows"] for b in loads.stream_backlog(query)) == 40


def test_skip_and_fresh(spark):
    batch = spark.createDataFrame([("a", 5), ("a", 7), ("b", 1)], "accn string, t int")
    assert loads.skip_loaded(batch, batch.where("accn = 'a'")).count() == 1
    marks = spark.createDataFrame([("a", 5), ("b", 0)], "accn string, latest int")
    assert sorted(map(tuple, loads.fresh_rows(batch, marks, "accn", "t").collect())) == [("a", 7), ("b", 1)]


def test_one_landed_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "GROUP_BYTES", 1 << 16)
    source, before = str(tmp_path / "in"), spark.conf.get(loads.SPLIT)
    rows = spark.range(0, 50_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 512).alias("v"))
    loads.land(rows, source)
    loads.land(rows.limit(7), source, mode="append")
    seen = []

    def load(batch, _):
        seen.append((batch.rdd.getNumPartitions(), batch.count()))

    monkeypatch.setattr(loads, "GROUP_BYTES", 1 << 20)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        loads.run_available(loads.read_landed(spark, source, "v string", 8), str(tmp_path / "state"), load)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [n for _, n in seen] == [50_007] and seen[0][0] > 2
    assert spark.conf.get(loads.SPLIT) == before


def test_batches_are_kept_on_disk_and_stored_keys_are_not_broadcast(spark, tmp_path, monkeypatch):
    seen, whole = [], loads.K.insert_ignore

    def spy(stored, rows, *how):
        new = whole(stored, rows, *how)
        seen.append((rows.storageLevel, new._jdf.queryExecution().executedPlan().toString()))
        return new

    monkeypatch.setattr(loads.K, "insert_ignore", spy)
    load = loads.insert_ignore_batches(str(tmp_path / "t"), ["k"], ["seq"])
    for number in range(2):
        load(spark.createDataFrame([(1, "a", 1), (number, "b", 2)], SCHEMA), number)
    assert all(level.useDisk and not level.useMemory for level, _ in seen) and len(seen) == 2
    assert all("SortMergeJoin" in plan and "BroadcastHashJoin" not in plan for _, plan in seen[1:])
    assert sorted(r.k for r in loads.loaded(spark, str(tmp_path / "t")).collect()) == [0, 1]
