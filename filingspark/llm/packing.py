"""Operator 3: documents packed into few sequences by linear grouping and best fit."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingspark.llm.memory import tidy
from filingspark.llm.tables import stored
from filingspark.llm.tokens import Encoder, vocabulary_path

ROOM = 1024
END = 2
SMALL = ROOM // 3
GROUPS = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def _pieces(path: str, room: int, end: int, with_ids: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Encoder(path)
        task = TaskContext.get().partitionId()
        met = np.zeros(room + 1, dtype=np.int64)
        for batch in batches:
            owner, piece, start, length, crc, nth, tokens = [], [], [], [], [], [], []
            for row, own in enumerate(known.ids(batch.column("text"))):
                ids = np.append(own, np.uint32(end)).astype("<u4")
                if with_ids:
                    tokens.append(ids)
                cuts = [0, *range((len(ids) - 1) % room + 1, len(ids) + 1, room)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    owner.append(row)
                    piece.append(i)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    nth.append(int(met[b - a]))
                    met[b - a] += 1
            columns = [
                batch.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                *[pa.array(c, pa.int64()) for c in (start, length, crc)],
                pa.array([task] * len(owner), pa.int32()), pa.array(nth, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
            if with_ids:  # the pieces of a batch lie one after the other
                flat = np.concatenate([*tokens, np.zeros(0, dtype="<u4")]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *length]), pa.int32()), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def configurations(sizes: list[int], wanted: list[int], room: int) -> list[tuple[np.ndarray, int]]:
    """Which slots to put together, and how often, for a few sizes with given counts.

    The linear relaxation by column generation: a knapsack over the room finds the
    configuration worth most at the present prices of the sizes, until none is worth
    more than a whole sequence. Its counts are rounded down; what is left over is
    less than one configuration per size.
    """
    size, need = np.array(sizes), np.array(wanted, dtype=np.float64)
    basis = np.diag((room // size).astype(np.float64))
    used = np.linalg.solve(basis, need)
    for _ in range(50 * len(sizes) + 50):
        price = np.linalg.solve(basis.T, np.ones(len(sizes)))
        worth = np.zeros(room + 1)
        last = np.full(room + 1, -1)
        for at in range(int(size.min()), room + 1):
            back = at - size
            value = np.where(back >= 0, worth[np.maximum(back, 0)] + price, -np.inf)
            best = int(value.argmax())
            if value[best] > worth[at - 1]:
                worth[at], last[at] = value[best], best
            else:
                worth[at] = worth[at - 1]
        if worth[room] <= 1 + 1e-9:
            break
        column, at = np.zeros(len(sizes)), room
        while at > 0:
            if last[at] < 0 or worth[at] == worth[at - 1]:
                at -= 1
                continue
            column[last[at]] += 1
            at -= size[last[at]]
        step = np.linalg.solve(basis, column)
        rising = step > 1e-9
        if not rising.any():
            break
        ratio = np.where(rising, used / np.where(rising, step, 1.0), np.inf)
        basis[:, int(ratio.argmin())] = column
        used = np.maximum(0.0, np.linalg.solve(basis, need))
    whole = np.floor(used + 1e-9).astype(np.int64)
    return [(basis[:, i].astype(np.int64), int(whole[i])) for i in np.flatnonzero(whole > 0)]


class Plan:
    """Where the n-th piece of each length goes, for given counts of lengths.

    Pieces of a length are alike, so a plan needs their counts only and is made of
    runs: ``count`` pieces of ``length`` from the ``nth`` on go to as many sequences
    from ``first`` on, each at ``offset``. Its size depends on the room, not on the
    number of pieces.
    """

    def __init__(self, counts: dict[int, int], room: int = ROOM, small: int = SMALL, groups: int = GROUPS):
        self.room = room
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.taken: dict[int, int] = defaultdict(int)
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.left)
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []
        if full := self.left.get(room, 0):
            self._take(room, full, self._new(full), 0)
        self._group({n: c for n, c in self.left.items() if n >= small}, groups)
        self._best_fit()
        self.runs.sort()

    def _new(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def _put(self, length: int, count: int, first: int, offset: int) -> None:
        self.runs.append((length, self.taken[length], count, first, offset))
        self.taken[length] += count

    def _free(self, room: int, first: int, count: int) -> None:
        if room <= 0 or count <= 0:
            return
        if not self.open[room]:
            insort(self.rooms, room)
        self.open[room].append((first, count))

    def _longest(self, most: int, least: int) -> int | None:
        """The greatest length from ``least`` to ``most`` of which pieces are left."""
        at = bisect_right(self.lengths, most) - 1
        return self.lengths[at] if at >= 0 and self.lengths[at] >= least else None

    def _take(self, length: int, count: int, first: int, offset: int) -> None:
        self._put(length, count, first, offset)
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]
            self.lengths.remove(length)

    def _group(self, large: dict[int, int], groups: int) -> None:
        """Linear grouping: equal groups of the large pieces, each rounded up to its largest.

        The slots of a configuration are filled with actual pieces of their groups, the
        longest first; since these are shorter than the rounded sizes, the last slot
        takes the longest piece of any group that the sequence still holds.
        """
        total = sum(large.values())
        if not total:
            return
        share = -(-total // groups)
        wanted: dict[int, int] = defaultdict(int)
        least: dict[int, int] = {}
        space, top = 0, 0
        for n in sorted(large, reverse=True):
            count = large[n]
            while count:
                if not space:
                    space, top = share, n
                part = min(space, count)
                wanted[top] += part
                least[top] = n
                space -= part
                count -= part
        sizes = list(wanted)
        for slots, times in configurations(sizes, list(wanted.values()), self.room):
            parts = [s for s, k in zip(sizes, slots) for _ in range(k)]
            while times:
                chosen, space, used = [], self.room, defaultdict(int)
                for i, size in enumerate(parts):
                    last = i == len(parts) - 1
                    n = self._longest(space if last else min(size, space), 1 if last else least[size])
                    while n is not None and used[n] >= self.left[n]:
                        n = self._longest(n - 1, 1 if last else least[size])
                    if n is None:
                        break
                    used[n] += 1
                    chosen.append(n)
                    space -= n
                if not chosen or len(chosen) < len(parts) and len(parts) > 1:
                    break
                step = min(times, *[self.left[n] // k for n, k in used.items()])
                first, offset = self._new(step), 0
                for n in chosen:
                    self._take(n, step, first, offset)
                    offset += n
                self._free(self.room - offset, first, step)
                times -= step

    def _best_fit(self) -> None:
        """What is left, from the longest down, each into the least room that holds it."""
        for n in sorted(self.left, reverse=True):
            count = self.left[n]
            while count:
                at = bisect_left(self.rooms, n)
                if at == len(self.rooms):
                    each = self.room // n
                    whole, rest = divmod(count, each)
                    for bins, fill in ((whole, each), (1, rest)):
                        if bins and fill:
                            first = self._new(bins)
                            for slot in range(fill):
                                self._put(n, bins, first, slot * n)
                            self._free(self.room - fill * n, first, bins)
                    break
                room = self.rooms[at]
                first, there = self.open[room].pop()
                if not self.open[room]:
                    self.rooms.pop(at)
                used = min(there, count)
                self._free(room, first + used, there - used)
                self._put(n, used, first, self.room - room)
                self._free(room - n, first, used)
                count -= used

    def table(self) -> np.ndarray:
        return np.array(self.runs, dtype=np.int64).reshape(-1, 5)


def _placed(runs: np.ndarray):
    length, nth, _, first, offset = runs.T
    keys = (length << 48) + nth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, (own << 48) + rank, side="right") - 1
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(first[at] + rank - nth[at]), pa.array(offset[at])],
                names=[*kept, "sequence_id", "offset"],
            )

    return run


def tokenised(
    docs: DataFrame, path: str | None = None, room: int = ROOM, end: int = END, ids: bool = False
) -> DataFrame:
    """Pieces of ``doc_id, text``: ids of the whole text and ``end``, cut every ``room`` tokens.

    The first piece of a cut document takes what does not fill a sequence. ``nth``
    counts the pieces of the same length within the task, so the rows must be stored
    before they are used. With ``ids`` a row also holds the ids themselves.
    """
    rows = docs.select("doc_id", "text")
    schema = PIECES + (", ids array<int>" if ids else "")
    return rows.mapInArrow(_pieces(path or vocabulary_path(), room, end, ids), schema)


def pack(
    docs: DataFrame, path: str | None = None, room: int = ROOM, end: int = END, ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, and on demand its ``ids``.

    A NULL or empty text is the single id ``end``; repeated rows are packed each for
    itself; an empty table gives no rows. The plan is made on the driver from the
    number of pieces of each length, at most ``room`` rows; a piece's place in its
    length is its place within its task and the counts of the tasks before it.
    """
    pieces = stored(tokenised(docs, path, room, end, ids), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    plan = Plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, room)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    ranked = pieces.join(before, ["length", "task"]).select(*kept, (F.col("before") + F.col("nth")).alias("rank"))
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if ids else "")
    return ranked.mapInArrow(_placed(plan.table()), f"{kinds}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from pieces with their ids: the pieces of a sequence in the order of their places."""
    piece = F.struct("offset", "ids")
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("_pieces")).select(
        "sequence_id", F.flatten(F.transform("_pieces", lambda p: p["ids"])).alias("ids")
    )
