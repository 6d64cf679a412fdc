"""Operator 9: exact Jaccard join on word shingles by parity sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingspark.llm.memory import tidy
from filingspark.llm.shingles import mixed, shingle_sets, slices
from filingspark.llm.tables import stored
from filingspark.operators.keys import spread_join
from filingspark.operators.similarity import connected_components

# Two sets link when 100 * intersection >= 80 * union, that is when the symmetric
# difference is at most a ninth of the sum of their sizes, and the smaller has at
# least four fifths of the larger.
TILE_ROWS = 1024
TILE_SHINGLES = 1 << 21
BROADCAST_ROWS = 1_000_000


def top_of_band(sizes: np.ndarray, step: int = 0) -> np.ndarray:
    """The largest size of each size's band, or of the band ``step`` above it.

    Each band reaches to five fourths of the one below, so partners lie in the same
    band or in neighbouring ones.
    """
    tops = [1, 2]
    while tops[-2] < sizes.max(initial=1):
        tops.append(max(tops[-1] + 1, tops[-1] * 5 // 4))
    ends = np.array(tops, dtype=np.int64)
    return ends[np.searchsorted(ends, sizes) + step]


def parts_of(top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest symmetric difference in a band, and the number of parts its sketches are cut into."""
    apart = 2 * top // 9
    return apart, apart + 1 + apart // 16 + np.where(apart > 4, 2, 0)


def keys_of(sets: list[np.ndarray], step: int) -> tuple[np.ndarray, np.ndarray]:
    """``(set number, key)``: the parts of the sketches of the sets, for one band scheme.

    A sketch has one bit per 64-bit code, flipped by each shingle; its leading bits
    name the part. Being sparse, a part is held as the exclusive or of the codes of
    its set bits. Two linked sets differ in at most ``apart`` parts and so agree in
    ``parts - apart``. Empty parts say little: a set gives keys for them only if it has
    ``parts - apart`` of them, and two linked sets agreeing in empty parts alone both do.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    top = top_of_band(sizes, step)
    apart, parts = parts_of(top)
    codes = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
    part = ((codes >> np.uint64(32)) * parts.astype(np.uint64)[owner] >> np.uint64(32)).astype(np.int64)
    fresh = np.ones(len(codes), dtype=bool)
    fresh[1:] = (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    parity = np.bitwise_xor.reduceat(codes, at)
    owners, part = owner[at], part[at]
    filled = np.bincount(owners, minlength=len(sets))
    bare = np.flatnonzero(parts - filled >= parts - apart)
    more = []
    for i in bare:
        own = part[np.searchsorted(owners, i) : np.searchsorted(owners, i, side="right")]
        absent = np.setdiff1d(np.arange(parts[i]), own)
        more.append((np.full(len(absent), i), absent))
    if more:
        owners = np.concatenate([owners, *[m[0] for m in more]])
        part = np.concatenate([part, *[m[1] for m in more]])
        parity = np.concatenate([parity, np.zeros(len(owners) - len(parity), dtype=np.uint64)])
    scheme = mixed(top[owners].astype(np.uint64) << np.uint64(32) ^ part.astype(np.uint64))
    return owners, mixed(parity ^ scheme)


def digest_of(shingles: np.ndarray) -> int:
    """64 bits that stand for a whole set."""
    folded = np.bitwise_xor.reduce(mixed(shingles))
    return int(mixed(np.array([folded ^ np.uint64(len(shingles))], dtype=np.uint64)).view(np.int64)[0])


def bits_of(shingles: np.ndarray) -> bytes:
    """A parity sketch of two to four bits per shingle; halves fold onto each other."""
    width = max(64, 1 << int(2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _sets(batches: Iterator[pa.RecordBatch], column: str = "text"):
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(column), 1 << 19):
            yield batch.slice(first, last - first), list(shingle_sets(data, offsets))


@tidy
def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, sets in _sets(batches):
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([digest_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([bits_of(s) if len(s) else None for s in sets], pa.binary()),
            ],
            names=["doc_id", "n", "node", "bits"],
        )


@tidy
def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # copies within the task give their keys once
    for _, sets in _sets(batches):
        fresh, nodes = [], []
        for s in sets:
            if len(s) and (node := digest_of(s)) not in seen:
                seen.add(node)
                fresh.append(s)
                nodes.append(node)
        if not fresh:
            continue
        ids = np.array(nodes, dtype=np.int64)
        for step in (0, 1):
            owners, keys = keys_of(fresh, step)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(ids[owners])], names=["key", "node"]
            )


def _unpacked(bits: list[bytes]) -> np.ndarray:
    """Sketches folded to the width of the smallest, as 64-bit words."""
    least = min(map(len, bits))
    out = np.empty((len(bits), least // 8), dtype=np.uint64)
    for i, b in enumerate(bits):
        row = np.frombuffer(b, dtype=np.uint64)
        while len(row) > out.shape[1]:
            row = row[: len(row) // 2] ^ row[len(row) // 2 :]
        out[i] = row
    return out


def near_in_tile(
    bits: list[bytes], sizes: np.ndarray, block: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row, the later rows (of the other block, if there are two) that its sketch allows."""
    words = _unpacked(bits)
    two = block.min() != block.max()
    for i in range(len(sizes) - 1):
        apart = np.bitwise_count(words[i] ^ words[i + 1 :]).sum(axis=1, dtype=np.int64)
        other = sizes[i + 1 :]
        fits = 9 * apart <= sizes[i] + other
        fits &= (5 * other >= 4 * sizes[i]) & (5 * sizes[i] >= 4 * other)
        if two:
            fits &= block[i + 1 :] != block[i]
        hits = np.flatnonzero(fits)
        if len(hits):
            yield i, hits + i + 1, apart[hits]


TILE = ["centre", "low", "high"]


def _survivors(tile: pa.Table) -> pa.Table:
    nodes = tile.column("node").to_numpy()
    sizes = tile.column("n").to_numpy()
    live = np.zeros(len(nodes), dtype=bool)
    for i, others, _ in near_in_tile(tile.column("bits").to_pylist(), sizes, tile.column("block").to_numpy()):
        live[i] = True
        live[others] = True
    return tile.select(["centre", "low", "high", "node", "block", "doc_id"]).filter(pa.array(live))


def forest_of(sets: list[np.ndarray], sizes: np.ndarray, block: np.ndarray) -> list[tuple[int, int]]:
    """Linked pairs that span the groups of a tile; pairs already connected are not met.

    Pairs with near sketches come first, as they mostly link and connect the tile, which
    spares the others. Only the pairs of one row are held at a time.
    """
    bits = [bits_of(s) for s in sets]
    group = np.arange(len(sets))
    found = []
    for share in (0.5, 1.0):
        for a, others, apart in near_in_tile(bits, sizes, block):
            live = (group[others] != group[a]) & (9 * apart <= share * (sizes[a] + sizes[others]))
            for b in others[live][np.argsort(apart[live], kind="stable")].tolist():
                if group[b] == group[a]:
                    continue
                joined = np.concatenate([sets[a], sets[b]])
                joined.sort()
                both = int((joined[1:] == joined[:-1]).sum())
                if 100 * both >= 80 * (len(joined) - both):
                    group[group == group[b]] = group[a]
                    found.append((a, b))
    return found


def _links(tile: pa.Table) -> pa.Table:
    ids = tile.column("doc_id").to_numpy()
    texts = pa.concat_arrays(tile.column("text").chunks)
    sets = [s for _, _, data, offsets in slices(texts) for s in shingle_sets(data, offsets)]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    found = forest_of(sets, sizes, tile.column("block").to_numpy())
    a, b = (np.array(side, dtype=np.int64) for side in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    return pa.table({"id_a": pa.array(ids[a], pa.int64()), "id_b": pa.array(ids[b], pa.int64())})


def links(docs: DataFrame, described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(classes, forest)``: equal sets with their least id, and links that span all linked classes."""
    filled = described.where("n > 0 and doc_id is not null")
    classes = stored(
        filled.groupBy("node", "n").agg(F.min("doc_id").alias("doc_id"), F.min("bits").alias("bits")), "classes"
    )
    keys = docs.select("text").where("text is not null").mapInArrow(_keyed, "key long, node long")
    members = keys.selectExpr("key", "node", "min(node) over (partition by key) as centre")
    star = stored(members.where("node <> centre").select("centre", "node").distinct(), "star")
    buckets = star.groupBy("centre").agg(F.count("*").alias("rows"))
    whole = star.unionByName(buckets.select("centre", F.col("centre").alias("node")))
    described_nodes = whole.join(classes, "node")
    room = F.greatest(
        F.lit(32), F.least(F.lit(TILE_ROWS), F.floor(F.lit(TILE_SHINGLES) / F.greatest("n", F.lit(1))))
    )
    blocks = (
        buckets.join(classes.select(F.col("node").alias("centre"), "n"), "centre")
        .select("centre", F.ceil((F.col("rows") + 1) / room).cast("int").alias("blocks"))
    )
    tiles = (
        described_nodes.join(blocks, "centre")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "_other"), "high": F.greatest("block", "_other")})
        .select(*TILE, "node", "block", "doc_id", "n", "bits")
    )
    live = stored(
        tiles.groupBy(*TILE).applyInArrow(
            _survivors, "centre long, low int, high int, node long, block int, doc_id long"
        ),
        "live",
    )
    wanted = live.select("doc_id").distinct()
    if live.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)  # at most BROADCAST_ROWS ids
    texts = stored(
        docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").groupBy("doc_id").agg(
            F.max("text").alias("text")
        ),
        "texts",
    )
    forest = live.join(texts, "doc_id").groupBy(*TILE).applyInArrow(_links, "id_a long, id_b long").distinct()
    return classes.select("node", "doc_id"), forest


def components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for rows ``doc_id, text``: linked documents share a component.

    Words are the runs of bytes other than blanks, A-Z in lower case; a document's set
    holds its distinct five-word shingles as 64-bit hashes, or its whole sequence if it
    has fewer words. NULL and blank texts have empty sets and are linked with nothing.
    ``component_id`` is the least doc_id reachable; rows with a NULL id stay alone with a
    NULL component. Repeated rows and copies share a class and are never paired. An id is
    expected to name one text: rows of one id with different texts keep their own counts
    but count as one document, whose links are those of the greatest of its texts.

    Sketch parts that two sets share put both in the bucket of the least of them; a bucket
    is cut into tiles of bounded size, where full sketches drop pairs whose Hamming distance
    exceeds what a link allows, and the texts of the rest are compared exactly. So a pair
    that meets in many parts is compared once per bucket, and a task emits only links that
    connect something new.
    """
    plain = docs.select("doc_id", "text")
    described = stored(plain.mapInArrow(_described, "doc_id long, n long, node long, bits binary"), "described")
    classes, forest = links(plain, described)
    joined = connected_components(forest)
    roots = classes.join(joined.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "node", F.coalesce("group_id", "doc_id").alias("component_id")
    )
    rows = described.select("doc_id", F.col("n").alias("n_shingles"), "node")
    linked = spread_join(rows, roots, ["node"], how="left", spread_on=["doc_id"])
    return linked.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    )
