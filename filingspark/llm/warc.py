"""WARC records of pages, as text columns, and the records of WARC files."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from io import BufferedReader
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingspark.llm.tables import stored
from filingspark.sources.archives import filesystem

END = "\r\n\r\n"
ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 20
FIRST_PIECE = 4 << 10
START_BYTES = 1 << 10
MOST_HEADER = 1 << 20
ROWS = 10_000
COPIES = 1000
TYPES = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
RECORDS = "archive string, offset long, length long, digest string, sound boolean"


def record_text(record_id: Column, uri: Column, block: Column) -> Column:
    """A WARC/1.1 resource record, with the digest of its block in its header."""
    block = F.coalesce(block, F.lit(""))
    lines = [
        F.lit("WARC/1.1"),
        F.lit("WARC-Type: resource"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("-")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.coalesce(F.regexp_replace(uri, r"[\r\n]", ""), F.lit(""))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Block-Digest: sha256:"), F.sha2(block, 256)),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block, F.lit(END))


def block_is_sound(record: Column) -> Column:
    """Whether a record's block has the digest that its header declares."""
    declared = F.regexp_extract(record, r"(?i)\r\nWARC-Block-Digest: sha256:([0-9a-f]{64})\r\n", 1)
    after = F.locate(END, record)
    block = F.substring(record, after + 4, F.length(record) - after - 7)
    return (after > 0) & (F.substring(record, -4, 4) == END) & (F.sha2(block, 256) == declared)


def laid_out(records: DataFrame, key: str, length: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Adds ``archive`` and ``offset``: records dealt over archives of about ``archive_bytes``.

    The archive hangs on a hash of all columns of the record and the number of its copy, the
    offset on the records with lower keys in it, so the layout is the same in every run, and
    many repeated rows go to many archives. Copies are counted before they travel.
    """
    columns = records.columns
    counted = records.groupBy(*columns).agg((F.count("*") - 1).alias("_last"))
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0), F.expr(f"_last div {COPIES}"))))
    within = F.sequence(F.lit(0), F.least(F.lit(COPIES - 1), F.expr(f"_last - _run * {COPIES}L")))
    numbered = runs.withColumn("_copy", F.explode(within)).withColumn("_copy", F.expr(f"_run * {COPIES}L + _copy"))
    records = stored(numbered.select(*columns, "_copy"), "records")
    total = records.agg(F.sum(length)).first()[0] or 0
    archives = max(1, -(-total // archive_bytes))
    dealt = records.withColumn("archive", F.pmod(F.xxhash64(*records.columns), F.lit(archives)))
    rest = [c for c in records.columns if c != key]
    order = Window.partitionBy("archive").orderBy(key, *rest).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("offset", F.coalesce(F.sum(length).over(order), F.lit(0))).drop("_copy")


def write_files(laid: DataFrame, record: str, path: str) -> None:
    """One plain WARC file per archive and task, its records in the order of their offsets."""
    ordered = laid.repartition("archive").sortWithinPartitions("archive", "offset")
    ordered.select("archive", record).write.partitionBy("archive").option("lineSep", END).text(path)


class _Check:
    """The digest of a record and whether its block is sound, from the record's bytes piece by piece."""

    def __init__(self):
        self.head, self.block, self.tail = b"", None, b""
        self.whole = hashlib.sha256()

    def feed(self, piece: bytes) -> None:
        self.whole.update(piece)
        if self.block is None:
            self.head += piece
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                if len(self.head) > MOST_HEADER:
                    raise ValueError("no end of the header")
                return
            self.head, piece = self.head[:end], self.head[end + 4 :]
            self.block = hashlib.sha256()
        held = self.tail + piece
        self.block.update(held[:-4])
        self.tail = held[-4:]

    def sound(self) -> bool:
        declared = re.search(rb"(?i)\r\nWARC-Block-Digest: sha256:([0-9a-f]{64})", self.head)
        ended = self.block is not None and self.tail == b"\r\n\r\n"
        return bool(declared) and ended and self.block.hexdigest().encode() == declared[1].lower()


def _pieces(file, start: int, stop: int) -> Iterator[bytes]:
    """The bytes between two places; pieces start small, as most records are."""
    size = FIRST_PIECE
    while start < stop:
        file.seek(start)
        piece = file.read(min(size, stop - start))
        if not piece:
            return
        start, size = start + len(piece), min(2 * size, PIECE)
        yield piece


def _packed(file, at: int, size: int) -> tuple[int, _Check] | None:
    """The end of the gzip member at ``at`` and its record; None where it is damaged or cut off."""
    member, check, end = zlib.decompressobj(wbits=31), _Check(), at
    try:
        for piece in _pieces(file, at, size):
            end += len(piece)
            while piece and not member.eof:
                check.feed(member.decompress(piece, PIECE))
                piece = member.unconsumed_tail
            if member.eof:
                return end - len(member.unused_data), check
        check.feed(member.flush())
        if member.eof:
            return end - len(member.unused_data), check
    except (zlib.error, ValueError):
        pass
    return None


def _plain(file, at: int, size: int) -> tuple[int, _Check] | None:
    """The end of the plain record at ``at``, by the length in its header; None without a whole record."""
    head = b""
    for piece in _pieces(file, at, min(size, at + MOST_HEADER)):
        head += piece
        if b"\r\n\r\n" in head:
            break
    end = head.find(b"\r\n\r\n")
    length = re.search(rb"(?i)\r\nContent-Length: *(\d{1,18})\r\n", head[: end + 2]) if end >= 0 else None
    stop = at + end + 4 + int(length[1]) + 4 if length and _starts(head[:START_BYTES]) else size + 1
    if stop > size:
        return None
    file.seek(stop - 4)
    if file.read(4) != b"\r\n\r\n":
        return None
    check = _Check()
    for piece in _pieces(file, at, stop):
        check.feed(piece)
    return stop, check


def _starts(first: bytes) -> bool:
    """Whether a record starts with these bytes, plain or packed."""
    if first[:3] == b"\x1f\x8b\x08":
        try:
            first = zlib.decompressobj(wbits=31).decompress(first, 64)
        except zlib.error:
            return False
    return bool(re.match(rb"WARC/\d+\.\d+\r\n[A-Za-z-]+:", first))


def _next_start(file, at: int, size: int) -> int:
    """The first place after ``at`` where a record starts, or the end of the file."""
    start, step = at + 1, FIRST_PIECE
    while start < size:
        file.seek(start)
        held = file.read(step + START_BYTES)
        for hit in re.finditer(rb"\x1f\x8b\x08|WARC/\d", held):
            if hit.start() < step and _starts(held[hit.start() : hit.start() + START_BYTES]):
                return start + hit.start()
        start, step = start + step, min(2 * step, PIECE)
    return size


def records_of(file, size: int) -> Iterator[tuple[int, int, str, bool]]:
    """``(offset, length, digest, sound)`` of every record of a seekable file, in pieces of ``PIECE`` bytes.

    Records are plain or in a gzip member each. A record that is damaged (a broken or cut off
    member, no length, a length that does not end at a record's end) reaches to the next place
    where a record starts; its digest is over the bytes as they are, and it is not sound.
    Nothing is read twice but what such a search passes over.
    """
    at = 0
    while at < size:
        file.seek(at)
        found = (_packed if file.read(2) == b"\x1f\x8b" else _plain)(file, at, size)
        if found is None:
            stop, whole = _next_start(file, at, size), hashlib.sha256()
            for piece in _pieces(file, at, stop):
                whole.update(piece)
            yield at, stop - at, whole.hexdigest(), False
        else:
            stop, check = found
            yield at, stop - at, check.whole.hexdigest(), check.sound()
        at = stop


def read_files(files: DataFrame) -> DataFrame:
    """The records of the WARC files ``path``: one row per record, damaged ones included.

    ``digest`` is over the record's bytes (unpacked, if it was packed), ``sound`` tells whether
    its block has the declared digest. A task streams through a file in pieces and holds neither
    the file nor a record; a header of more than ``MOST_HEADER`` bytes counts as damaged. Files
    are dealt over the tasks one by one; NULL paths and empty files have no records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in filter(None, batch.column("path").to_pylist()):
                store, inner = filesystem(path)
                with store.open_input_file(inner) as raw:
                    found = records_of(BufferedReader(raw, PIECE), raw.size())
                    while rows := list(islice(found, ROWS)):
                        columns = [pa.array(c, t) for c, t in zip(zip(*rows), TYPES)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(rows), pa.string()), *columns],
                            names=["archive", "offset", "length", "digest", "sound"],
                        )

    paths = files.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(run, RECORDS)
