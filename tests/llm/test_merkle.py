"""Operator 5: what is damaged is found, and nothing else is read."""

from __future__ import annotations

import gzip
import hashlib
import io
import random
import time
import zlib
from itertools import accumulate

from pyspark.sql import functions as F

from filingspark.llm import merkle, warc

RECORD = "replica string, archive long, offset long, length long, digest string, sound boolean, key long"


def _archive(count=900, archives=20, seed=1):
    draw = random.Random(seed)
    rows = []
    for archive in range(archives):
        at = 0
        for _ in range(count // archives):
            size = draw.choice([200, 3000, 70_000])
            rows.append((archive, at, size, hashlib.sha256(draw.randbytes(8)).hexdigest(), True, len(rows)))
            at += size
    return rows


def _faults(spark, by_name):
    rows = [(n, *r) for n, own in by_name.items() for r in own]
    frame = spark.createDataFrame(rows, RECORD).repartition(3)
    got = merkle.audit(frame, list(by_name)).collect()
    return sorted((r["replica"], r["fault"], r["archive"], r["offset"], r["key"]) for r in got)


def test_faults_are_found(spark):
    whole = _archive()
    changed, lost, odd = list(whole), list(whole), list(whole)
    changed[5] = (*whole[5][:3], "0" * 64, False, whole[5][5])
    gone = lost.pop(700)
    odd[899] = (*whole[899][:3], "f" * 64, True, whole[899][5])
    changed.append(changed[17])  # a row listed twice is a difference of its leaf, not a fault
    want = [
        ("b", "corrupt", *whole[5][:2], whole[5][5]),
        ("c", "missing", *gone[:2], gone[5]),
        ("d", "odd", *whole[899][:2], whole[899][5]),
    ]
    assert _faults(spark, {"a": whole, "b": changed, "c": lost, "d": odd}) == want


def test_like_replicas_and_empty_tables(spark):
    whole = _archive(40, 2)
    assert _faults(spark, {"a": whole, "b": whole}) == []
    assert _faults(spark, {"a": [], "b": []}) == []
    assert len(_faults(spark, {"a": whole, "b": []})) == len(whole)


def test_only_differing_branches_are_descended(spark):
    whole = _archive()
    other = list(whole)
    other[100] = (*whole[100][:3], "0" * 64, False, whole[100][5])
    frame = spark.createDataFrame([(n, *r) for n, own in (("a", whole), ("b", other)) for r in own], RECORD)
    levels = merkle.trees(frame)
    assert levels[-1].groupBy("replica").count().where("count <> 1").count() == 0
    assert [r["records"] for r in levels[-1].collect()] == [len(whole)] * 2
    assert merkle.mismatching(levels, ["a", "b"]).count() == 1


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_pages(spark):
    rows = [(i, f"http://x/{i}", f"<p>{'é' * (i % 50)} {i}</p>") for i in range(400)]
    rows += [(None, None, None), (7, None, ""), (7, None, ""), (8, "a\r\nb", "x\r\n\r\ny" * 1000)]
    frame = merkle.page_replicas(_pages(spark, rows).selectExpr("*", "1 as archive", "2 as offset", "3 as length"))
    held = frame.groupBy("replica").agg(F.count("*").alias("n"), F.countDistinct("archive", "offset").alias("d")).collect()
    assert all(r["n"] == r["d"] for r in held)
    kept = {r["replica"]: r["n"] for r in held}
    assert kept["a"] == kept["c"] == len(rows) and kept["b"] < len(rows)
    sound = frame.where("replica = 'a'").agg(F.min("sound")).first()[0]
    assert sound is True
    assert merkle.audit(frame, ["a", "b", "c"]).count() > 0
    assert merkle.audit(merkle.page_replicas(_pages(spark, [])), ["a", "b", "c"]).count() == 0


def test_files_round_trip(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"line\r\n\r\nßtext {i}" * (i + 1)) for i in range(30)]
    text = warc.record_text(F.col("page_id"), F.col("url"), F.col("html"))
    records = _pages(spark, rows).select("page_id", text.alias("record")).select(
        "page_id", "record", F.octet_length("record").cast("long").alias("length")
    )
    laid = warc.laid_out(records, "page_id", "length", archive_bytes=4000)
    bodies = laid.withColumn("record", F.expr("substr(record, 1, length(record) - 4)"))
    warc.write_files(bodies, "record", str(tmp_path / "warc"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.txt"
    ).load(str(tmp_path / "warc"))
    got = warc.read_files(files)
    want = laid.select(F.sha2("record", 256).alias("digest"), "offset", "length").collect()
    assert {tuple(r) for r in got.select("digest", "offset", "length").collect()} == {tuple(r) for r in want}
    assert got.where("not sound").count() == 0


def _record(body, n=0):
    head = f"WARC/1.1\r\nWARC-Record-ID: {n}\r\nWARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}\r\n"
    return head.encode() + f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def _read(content):
    return [(at, length, sound) for at, length, _, sound in warc.records_of(io.BytesIO(content), len(content))]


def test_members_of_gzip_and_broken_files():
    one, two, three = _record(b"abc"), _record(b""), _record(b"line\r\n\r\nWARC/1.0 quoted" * 9)
    plain = one + two + three
    at = [0, len(one), len(one) + len(two), len(plain)]
    assert _read(plain) == [(a, b - a, True) for a, b in zip(at, at[1:])]
    packed = [gzip.compress(r) for r in (one, two, three)]
    ends = [0, *accumulate(map(len, packed))]
    assert _read(b"".join(packed)) == [(a, b - a, True) for a, b in zip(ends, ends[1:])]
    digests = [d for _, _, d, _ in warc.records_of(io.BytesIO(b"".join(packed)), ends[-1])]
    assert digests == [hashlib.sha256(r).hexdigest() for r in (one, two, three)]
    assert _read(one + b"rest") == [(0, len(one), True), (len(one), 4, False)]
    assert _read(one[:-6] + two) == [(0, len(one) - 6, False), (len(one) - 6, len(two), True)]
    assert _read(b"junk" + one) == [(0, 4, False), (4, len(one), True)]
    assert _read(one.replace(b"Length: 3", b"Length: 4") + two) == [(0, len(one), False), (len(one), len(two), True)]
    assert _read(one.replace(b"abc", b"abd") + two) == [(0, len(one), False), (len(one), len(two), True)]
    assert _read(b"") == []


def test_every_flipped_byte_of_a_member_is_one_unsound_row():
    packed = [gzip.compress(_record(f"body {i} {i * 7919}".encode(), i), mtime=0) for i in range(3)]
    first, second = len(packed[0]), len(packed[0]) + len(packed[1])
    for place in range(first, second):
        content = bytearray(b"".join(packed))
        content[place] ^= 0x41
        got = _read(bytes(content))
        sound = [r[0] for r in got if r[2]]
        assert sound[0] == 0 and sound[-1] == second  # the neighbours are found as before
        covered = sum(r[1] for r in got)
        assert covered == len(content)
    cut = b"".join(packed)[:-5]
    assert _read(cut)[-1] == (second, len(cut) - second, False)


def test_time_is_linear_in_the_members():
    member = gzip.compress(_record(b"x" * 300))
    content = member * 100_000
    began = time.monotonic()
    assert sum(sound for _, _, sound in _read(content)) == 100_000
    assert time.monotonic() - began < 60


def test_repeated_rows_go_to_many_archives(spark):
    rows = spark.range(5000).selectExpr("1L as page_id", "100L as length")
    laid = warc.laid_out(rows, "page_id", "length", archive_bytes=10_000)
    assert laid.count() == 5000 and laid.select("archive", "offset").distinct().count() == 5000
    assert laid.groupBy("archive").count().agg(F.max("count")).first()[0] < 300


def _plainly(pages):
    """Faults of the replicas, from the rules on the ids and each record's bytes."""
    faults = []
    for page_id, url, html in pages:
        spun = zlib.crc32(str(page_id).encode())
        body = (html or "").encode()
        text = "\r\n".join([
            "WARC/1.1", "WARC-Type: resource", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Target-URI: {(url or '').replace(chr(13), '').replace(chr(10), '')}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}",
            f"Content-Length: {len(body)}",
        ]) + "\r\n\r\n" + (html or "") + "\r\n\r\n"
        half = len(text) // 2

        def fault(form):
            head, _, rest = form.partition("\r\n\r\n")
            digest = hashlib.sha256(rest[:-4].encode()).hexdigest()
            sound = rest.endswith("\r\n\r\n") and f"\r\nWARC-Block-Digest: sha256:{digest}\r\n" in head + "\r\n"
            return "odd" if sound else "corrupt"

        if spun % 103 == 7:
            faults.append((page_id, "b", "missing"))
        elif spun % 97 == 3:
            faults.append((page_id, "b", fault(text[:half] + "\0" + text[half + 1 :])))
        if spun % 101 == 5:
            faults.append((page_id, "c", fault(text[:half])))
    return sorted(faults)


def test_every_damaged_page_is_reported(spark):
    rows = [(i, f"http://x/{i}", f"<p>{'é' * (i % 50)} {i}</p>" * (i % 9)) for i in range(3000)]
    found = merkle.audit(merkle.page_replicas(_pages(spark, rows)), ["a", "b", "c"])
    got = sorted((r["key"], r["replica"], r["fault"]) for r in found.collect())
    want = _plainly(rows)
    assert got == want and {w[2] for w in want} == {"missing", "corrupt", "odd"}


def test_soundness(spark):
    text = warc.record_text(F.lit(1), F.lit("u"), F.lit("body é"))
    frame = spark.range(1).select(text.alias("r"))
    half = F.expr("substr(r, 1, length(r) - 5)")
    got = frame.select(
        warc.block_is_sound(F.col("r")), warc.block_is_sound(merkle.flipped(F.col("r"))), warc.block_is_sound(half),
        warc.block_is_sound(F.lit("")), warc.block_is_sound(F.regexp_replace("r", "body", "bodx")),
    ).first()
    assert list(got) == [True, False, False, False, False]
