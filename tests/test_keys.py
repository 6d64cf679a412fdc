from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from filingspark import schemas
from filingspark.operators import keys as K
from filingspark.sources import tables as store


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_first_wins_keeps_null_keys(spark):
    df = spark.createDataFrame(
        [(1, "a", 3), (1, "a", 1), (2, None, 5), (2, None, 5), (None, "a", 2)], "k int, l string, seq int"
    )
    assert rows(K.first_wins(df, ["k", "l"], ["seq"])) == sorted(
        [(1, "a", 1), (2, None, 5), (2, None, 5), (None, "a", 2)], key=repr
    )


def test_first_wins_with_map_column(spark):
    df = spark.sql("SELECT 1 AS k, 2 AS seq, map('a', 1) AS m UNION ALL SELECT 1, 1, map('b', 2)")
    assert [r.m for r in K.first_wins(df, ["k"], ["seq"]).collect()] == [{"b": 2}]


def test_first_wins_of_key_columns_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(K.first_wins(df, ["k"], ["k"])) == [(1,), (2,)]


def test_insert_ignore_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame(
        [("a", 1, 10), ("a", 1, 9), ("b", 1, 1), ("b", None, 2)], "k string, l int, seq int"
    )
    store.insert_ignore_into(batch, path, ["k", "l"], ["seq"])
    first = rows(spark.read.parquet(path))
    assert first == sorted([("a", 1, 9), ("b", 1, 1), ("b", None, 2)], key=repr)
    store.insert_ignore_into(batch.where("l IS NOT NULL"), path, ["k", "l"], ["seq"])
    assert rows(spark.read.parquet(path)) == first


def test_upsert_and_delete(spark):
    target = spark.createDataFrame([(1, "old", 99), (2, "kept", 1)], "id int, v string, seq int")
    batch = spark.createDataFrame([(1, "new", 1), (1, "newest", 2), (3, "added", 1)], target.schema)
    merged = K.upsert(target, batch, ["id"], ["seq"])
    assert rows(merged) == [(1, "newest", 2), (2, "kept", 1), (3, "added", 1)]
    assert rows(K.delete_where(merged, F.col("v") == "kept").select("id")) == [(1,), (3,)]
    odd = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    assert rows(K.delete_where(odd, F.col("v") == "x").select("id")) == [(1,)]
    assert rows(K.delete_ids(merged, batch, "id").select("id")) == [(2,)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("subset", [False, True])
def test_spread_join_equals_join(spark, how, subset):
    rng = random.Random(7)
    big_rows = [(i, rng.choice([1, 1, 1, 2, 3, None, 9]), rng.randint(0, 1)) for i in range(600)]
    big = spark.createDataFrame(big_rows, "id int, k int, l int")
    small = spark.createDataFrame([(k, l, f"{k}{l}") for k in (1, 2, 3) for l in (0, 1)], "k int, l int, v string")
    counts = big.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("_n")) if subset else None
    spread = K.spread_join(big, small, ["k", "l"], how, ["id"], rows_per_task=20, counts=counts)
    plain = big.join(small, ["k", "l"], how)
    assert sorted(spread.columns) == sorted(plain.columns)
    assert rows(spread.select(plain.columns)) == rows(plain)


def test_spread_join_spreads_the_hot_key(spark):
    big = spark.range(1000).select(F.col("id"), F.lit(1).alias("k"))
    small = spark.createDataFrame([(1, "x")], "k int, v string")
    plan = K.spread_join(big, small, ["k"], spread_on=["id"], rows_per_task=100)
    assert plan.count() == 1000
    salts = big.select(F.pmod(F.xxhash64("id"), F.lit(10)).alias("s")).distinct().count()
    assert salts == 10


def test_create_tables_is_repeatable(spark, tmp_path):
    root = str(tmp_path)
    store.create_tables(spark, root)
    row = spark.createDataFrame([("0000000001", "A", "Alpha")], schemas.TABLES["symbols"])
    store.append(row, f"{root}/symbols")
    store.create_tables(spark, root)
    assert spark.read.parquet(f"{root}/symbols").count() == 1
    listed = store.describe_tables(spark, root, ["technicals"]).orderBy("position")
    assert [r.column for r in listed.collect()][:2] == ["ticker", "datetime"]
    assert set(schemas.KEYS) == set(schemas.TABLES)


def test_append_turns_blank_to_null(spark, tmp_path):
    path = str(tmp_path / "t")
    store.append(spark.createDataFrame([("", 1), ("x", 2)], "s string, n int"), path)
    assert rows(spark.read.parquet(path)) == sorted([(None, 1), ("x", 2)], key=repr)


def test_clustered_table_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(400).select(F.format_string("%010d", F.col("id") % 20).alias("cik"), F.col("id"))
    store.write_clustered(df, path, buckets=4)
    assert spark.read.parquet(path).count() == 400
    found = store.read_clustered(spark, path, "cik", ["0000000003"])
    assert sorted(r.id for r in found.collect()) == list(range(3, 400, 20))
