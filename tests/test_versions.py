"""Tables changed by key: touched buckets only, and old or new rows at any moment."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from filingspark.sources import versions

SCHEMA = "id long, seq int, v string"


def _table(spark, path, count=400):
    return versions.create(spark.range(count).selectExpr("id", "0 as seq", "concat('v', id) as v"), path, ["id"], 16)


def _files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).glob("data/*/*/*.parquet")}


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_untouched_buckets_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    table = _table(spark, path)
    before = _files(path)
    batch = spark.createDataFrame([(3, 1, "a"), (3, 2, "b"), (1000, 1, "new"), (None, 1, "n")], SCHEMA)
    table.upsert(batch, ["seq"])
    rows = {r["id"]: r["v"] for r in table.rows().collect()}
    assert rows == {i: f"v{i}" for i in range(400)} | {3: "b", 1000: "new", None: "n"}
    after = _files(path)
    assert {f: after[f] for f in before} == before  # nothing is overwritten
    written = {Path(f).parent.name for f in after.keys() - before.keys()}
    assert 1 <= len(written) <= 3
    live = table._live(table.version())
    assert sum(1 for b, w in live.items() if w != table._live(1).get(b)) == len(written)


def test_delete(spark, tmp_path):
    path = str(tmp_path / "t")
    table = _table(spark, path)
    table.delete_ids(spark.createDataFrame([(5,), (7777,)], "id long"))
    table.delete_where(F.col("id") == 6)
    version = table.version()
    table.delete_where(F.col("id") < 0)  # no such row: no new version
    assert table.version() == version == 3
    assert sorted(r["id"] for r in table.rows().collect()) == [i for i in range(400) if i not in (5, 6)]
    table.delete_where(F.lit(True))
    assert table.rows().count() == 0 and table.rows(1).count() == 400
    table.upsert(spark.createDataFrame([(1, 1, "back")], SCHEMA), ["seq"])
    assert _sorted(versions.open_table(spark, path).rows()) == [(1, 1, "back")]


def test_a_job_that_fails_changes_nothing(spark, tmp_path):
    table = _table(spark, str(tmp_path / "t"))
    bad = spark.createDataFrame([(1, 1, "x")], SCHEMA).withColumn("v", F.expr("raise_error('lost')").cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(bad, ["seq"])
    assert table.version() == 1 and table.rows().count() == 400


def test_second_of_two_changes_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table, other = _table(spark, path), versions.open_table(spark, path)
    one = spark.createDataFrame([(1, 1, "first")], SCHEMA)
    other.upsert(one, ["seq"])
    monkeypatch.setattr(versions.Versioned, "version", lambda self: 1)  # it began before the other had ended
    with pytest.raises(Exception, match="exist"):
        table.upsert(one.withColumn("v", F.lit("second")), ["seq"])
    monkeypatch.undo()
    assert table.rows().where("id = 1").first()["v"] == "first"


def test_forget(spark, tmp_path):
    path = str(tmp_path / "t")
    table = _table(spark, path)
    for i in range(3):
        table.upsert(spark.createDataFrame([(i, 1, "x")], SCHEMA), ["seq"])
    whole, files = _sorted(table.rows()), len(_files(path))
    table.forget()
    assert _sorted(table.rows()) == whole and len(_files(path)) < files
    assert [p.name for p in Path(path, "live").glob("*.json")] == ["4.json"]


def test_empty_table(spark, tmp_path):
    table = versions.create(spark.createDataFrame([], SCHEMA), str(tmp_path / "t"), ["id"])
    assert table.rows().columns == ["id", "seq", "v"] and table.rows().count() == 0
    table.upsert(spark.createDataFrame([(1, 1, "a")], SCHEMA), ["seq"])
    assert _sorted(table.rows()) == [(1, 1, "a")]
