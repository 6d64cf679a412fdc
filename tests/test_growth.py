"""Work that must grow no faster than its input."""

import zipfile

import pytest
from pyspark.sql import functions as F

from filingspark.operators import flatten
from filingspark.operators import keys as K
from filingspark.operators import similarity as S
from filingspark.plans.proxies import Tables
from filingspark.sources import archives, feeds
from filingspark.streaming import loads


def _archive(path, entries, comment=b""):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, text in entries:
            out.writestr(name, text)
        out.comment = comment
    return str(path)


def test_runs_cover_a_directory_once(tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "DIRECTORY_BYTES", 100)  # cuts entries of the directory
    entries = [(f"a{i}.json", f'{{"cik": {i}}}' * (i % 7)) for i in range(500)]
    path = _archive(tmp_path / "a.zip", entries, b"PK a comment")
    runs = list(archives._runs(path, 200))
    assert len(runs) > 20
    places = [(first, first + length) for _, _, first, length in runs]
    assert all(a[1] == b[0] for a, b in zip(places, places[1:]))
    assert [row for run in runs for row in archives._read_run(path, *run)] == entries


def test_runs_of_an_archive_behind_other_bytes(tmp_path):
    path = _archive(tmp_path / "a.zip", [("a", "1"), ("b", "2")])
    shifted = tmp_path / "b.zip"
    shifted.write_bytes(b"x" * 1000 + open(path, "rb").read())
    runs = list(archives._runs(str(shifted), 1))
    assert [row for run in runs for row in archives._read_run(str(shifted), *run)] == [("a", "1"), ("b", "2")]


def test_runs_of_an_archive_with_wide_offsets(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)  # more entries are listed in the 64-bit form
    path = _archive(tmp_path / "a.zip", [(f"e{i}", str(i)) for i in range(9)])
    assert b"PK\6\6" in open(path, "rb").read()
    runs = list(archives._runs(path, 3))
    assert [row for run in runs for row in archives._read_run(path, *run)] == [(f"e{i}", str(i)) for i in range(9)]


def test_unusual_entries_are_read(tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr("plain", "1" * 99, zipfile.ZIP_STORED)
        out.writestr("\u00e9\u4e2d.json", '{"a": "\u00e9"}')
        out.writestr("folder/", "")
        out.writestr("folder/placeholder.txt", "no")
        out.writestr("none", "")
    want = [("plain", "1" * 99), ("\u00e9\u4e2d.json", '{"a": "\u00e9"}'), ("none", "")]
    assert [row for run in archives._runs(path, 1) for row in archives._read_run(path, *run)] == want
    with zipfile.ZipFile(path, "a", zipfile.ZIP_BZIP2) as out:
        out.writestr("bz", "2" * 99)
    found = [row for run in archives._runs(path, 10**6) for row in archives._read_run(path, *run)]
    assert found == [*want, ("bz", "2" * 99)]


def test_a_damaged_entry_is_an_error(tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as out:
        out.writestr("a", "12345")
    path.write_bytes(path.read_bytes().replace(b"12345", b"12346"))
    with pytest.raises(zipfile.BadZipFile):
        [row for run in archives._runs(str(path), 10) for row in archives._read_run(str(path), *run)]


@pytest.mark.parametrize("count", [0, 5, 70_000])
def test_packed_archives_are_read_by_zipfile(tmp_path, count):
    entries = [(f"n\u00e9{i}" if i % 2 else f"n{i}", "x\u00e9" * (i % 50)) for i in range(count)]
    with open(tmp_path / "a.zip", "wb") as out:
        assert archives._pack(out, ((n.encode(), c.encode()) for n, c in entries)) == count
    with zipfile.ZipFile(tmp_path / "a.zip") as found:
        assert found.testzip() is None
        assert [(i.filename, found.read(i).decode()) for i in found.infolist()] == entries


def test_waves_hold_some_archives_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "WAVE_BYTES", 1)
    ids = spark.range(2000).repartition(100, "id")
    df = ids.select(F.col("id").cast("string").alias("entry"), F.repeat(F.lit("x"), F.col("id").cast("int") % 9).alias("content"))
    made, rows, most = set(), [], 0
    for wave in archives.write_waves(df, str(tmp_path / "z")):
        assert not made & set(wave)
        made |= set(wave)
        most = max(most, len(list((tmp_path / "z").glob("*.zip"))))
        rows += archives.zip_scan(spark, wave).select("entry", "content").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, df.collect()))
    assert len(made) > 50 and most <= 4 * spark.sparkContext.defaultParallelism
    assert not list((tmp_path / "z").glob("*"))
    waves = archives.write_waves(df.where("false"), str(tmp_path / "none"))
    assert [archives.zip_scan(spark, wave).count() for wave in waves] == [0]


def test_no_archive_is_an_error(tmp_path):
    (tmp_path / "a.zip").write_bytes(b"not an archive" * 9)
    with pytest.raises(zipfile.BadZipFile):
        list(archives._runs(str(tmp_path / "a.zip"), 10))


def test_an_empty_archive_has_no_runs(tmp_path):
    assert list(archives._runs(_archive(tmp_path / "a.zip", []), 10)) == []


def test_many_runs_share_tasks():
    assert [archives._tasks(n) for n in (0, 5, 64, 1000, 6400)] == [1, 5, 64, 64, 200]


def test_first_wins_makes_its_input_once(spark):
    rows = [(None, 1, 0.0), (None, 1, 0.0), (None, 1, -0.0), ("a", 2, 1.0), ("a", 1, 3.0), ("a", 1, 2.0)]
    df = spark.createDataFrame(rows, "k string, o int, v double")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    found = K.first_wins(df.mapInPandas(count, df.schema), ["k"], ["o"]).collect()
    assert sorted(str(tuple(r)) for r in found) == [
        "('a', 1, 2.0)", "(None, 1, -0.0)", "(None, 1, 0.0)", "(None, 1, 0.0)"
    ]
    assert seen.value == len(rows)


def test_visitors_of_a_cell_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE_ROWS", 8)
    rows = [(0, 0, 3 if i < 16 else 2, i, [1.0, float(i)]) for i in range(1000)]
    cells = spark.createDataFrame(rows, "cell int, sub int, home int, id long, vec array<float>")
    tiles = S._tiles(cells).toPandas()
    # 984 visitors meet 2 blocks, 16 rows at home meet 2 + 123; all with all would be 125,000 rows
    assert len(tiles) == 984 * 2 + 16 * 125
    met = set()
    for _, tile in tiles.groupby(["p", "q"]):
        low, high = tile["p"].iloc[0], tile["q"].iloc[0]
        left, right = (tile.loc[tile["own"] == x, "id"] for x in (low, high))
        met |= {(min(a, b), max(a, b)) for a in left for b in right if a != b}
    assert met == {(a, b) for a in range(16) for b in range(a + 1, 1000)}


def test_concepts_left_out_are_not_read(spark):
    seen = '[{"val":"7.9","accn":"x","fy":2020,"end":"2020-01-31"}]'
    text = (
        '{"cik":5,"facts":{"dei":{"EntityCommonStockSharesOutstanding":{"units":{"shares":%s}},'
        '"EntityPublicFloat":{"units":{"USD":%s,"EUR":%s}}},"us-gaap":{"A":{"units":{"u":%s}}},"ifrs":{"B":{"units":{"u":%s}}}}}'
    ) % ((seen,) * 5)
    rows = [(text,), ('{"cik":6}',), ('{"cik":7,"facts":{"us-gaap":null,"dei":{}}}',), ('{"facts":{}}',), (None,), ("{",)]
    df = spark.createDataFrame(rows, "content string")
    for table, only in (
        (flatten.shares_outstanding, flatten.SHARES_ONLY), (flatten.public_float, flatten.FLOAT_ONLY),
        (flatten.accounting_facts, flatten.ACCOUNTING_ONLY),
    ):
        part = feeds.company_facts(df, only=only)
        assert table(part).collect() == table(feeds.company_facts(df)).collect()
        assert "map<string,map<" not in dict(part.dtypes)["facts"]


def test_batches_write_a_file_for_each_bucket(spark, tmp_path):
    rows = spark.range(2000, numPartitions=8).select("id", F.lit(1).alias("o"))
    load = loads.insert_ignore_batches(str(tmp_path / "t"), ["id"], ["o"], buckets=4)
    load(rows, 0)
    load(rows, 1)
    assert loads.loaded(spark, str(tmp_path / "t")).count() == 2000
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 8


def test_facts_are_shuffled_by_the_key_of_their_join(spark, tmp_path, monkeypatch):
    spark.range(50).selectExpr("id AS l_orderkey").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr("filingspark.plans.proxies.DEALT_ROWS", 1)
    plan = Tables(spark, str(tmp_path)).dealt("lineitem", "l_orderkey")._jdf.queryExecution().toString()
    assert "RoundRobin" not in plan and "hashpartitioning(l_orderkey" in plan
