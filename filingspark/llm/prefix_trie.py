"""Operator 13: the trie of all prefixes of conversations, by union-find over sorted neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingspark.llm.tables import stored, task_count
from filingspark.operators.keys import spread_join

GROUP = 20
HEADS = 4
DIGEST = 16
BLOCK_TURNS = 65_536
BROADCAST_ROWS = 100_000
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of each conversation in order, as digest and number of words.

    Turns are ordered by ``turn``, NULL first, and those that share one by their digest;
    a NULL role or text is empty. Rows without ``conv_id`` belong to no conversation. The
    texts stay behind: a turn is known by 128 bits of the SHA-256 of role and text, so a
    conversation is one row of about 30 bytes a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn"),
            F.substring(F.sha2(framed, 256), 1, 2 * DIGEST).alias("digest"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        ).alias("t"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(lists: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Each conversation begun with turns of the first one of its group.

    With ``h`` the CRC-32 of the decimal id modulo ``heads``: the first ``h`` turns of
    conversation ``c - c mod group``, all if it has fewer and none if there is none, then
    the own turns from the ``h``-th on.
    """
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    first = lists.where(F.pmod("conv_id", F.lit(group)) == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    none = F.expr("slice(turns, 1, 0)")
    return (
        lists.withColumn("base", base).join(first, "base", "left")
        .select("conv_id", F.concat(
            F.slice(F.coalesce("head", none), F.lit(1), h),
            F.slice("turns", h + 1, F.size("turns")),
        ).alias("turns"))
    )


def keyed(lists: DataFrame) -> DataFrame:
    """``conv_id, key, words``: the digests of all turns in a row, and the words of each turn."""
    return lists.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


BLOCKS = "part int, block int, first binary, last binary, convs array<long>, keys array<binary>, words array<array<long>>"


def _blocks(turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, held, rows = TaskContext.get().partitionId(), 0, 0, []

        def cut() -> pa.RecordBatch:
            convs, keys, words = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([block], pa.int32()),
                    pa.array([keys[0]], pa.binary()), pa.array([keys[-1]], pa.binary()),
                    pa.array([convs], pa.list_(pa.int64())), pa.array([keys], pa.list_(pa.binary())),
                    pa.array([words], pa.list_(pa.list_(pa.int64()))),
                ],
                names=["part", "block", "first", "last", "convs", "keys", "words"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                for row in zip(*(some.column(c).to_pylist() for c in ("conv_id", "key", "words"))):
                    if held >= turns:
                        yield cut()
                        block, held, rows = block + 1, 0, []
                    rows.append(row)
                    held += 1 + len(row[2])
        if rows:
            yield cut()

    return run


def shared(a: bytes | None, b: bytes | None) -> int:
    """How many turns two conversations begin with alike; -1 where there is none to compare with."""
    if a is None or b is None:
        return -1
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // DIGEST
    low, high = 0, size // DIGEST  # alike up to low, not up to high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * DIGEST : middle * DIGEST] == b[low * DIGEST : middle * DIGEST]:
            low = middle
        else:
            high = middle
    return low


class Forest:
    """The trie nodes of one block of sorted conversations.

    The distinct sequences start as components of one node each. Edges between sorted
    neighbours, weighted by the number of turns they share, are taken in descending order;
    each merge of two components makes, or widens, the node in which they meet, and the
    turns passed on the way up to it are nodes with one child. What the block shares with
    the sequences before and after it stays open: its figures are sums to which other
    blocks add theirs. A node's ``begins`` is False if it was met in an earlier block.
    """

    def __init__(self, convs: list, keys: list, words: list, before: bytes | None, after: bytes | None):
        self.before, self.after = shared(before, keys[0]), shared(keys[-1], after)
        firsts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        ends = [*firsts[1:], len(keys)]
        self.keys, self.words = [keys[i] for i in firsts], [words[i] for i in firsts]
        self.members = [convs[a:b] for a, b in zip(firsts, ends)]
        self.depth, self.of, self.n, self.least = [], [], [], []
        self.children, self.leaves, self.inner, self.parent = [], [], [], []
        self.own: dict[int, int] = {}  # node of the sequence that ends there
        count = len(self.keys)
        depths = [len(k) // DIGEST for k in self.keys]
        edges = [shared(a, b) for a, b in zip(self.keys, self.keys[1:])]
        top = []
        for i in range(count):
            following = edges[i] if i + 1 < count else self.after
            leaf = following < depths[i]  # neither goes on in the next block nor is extended
            top.append(self._node(depths[i], i, len(self.members[i]), self.members[i][0], 0, int(leaf), 0))
            self.own[top[i]] = i
        root = list(range(count))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i in sorted(range(count - 1), key=lambda i: -edges[i]):
            a, b, depth = find(i), find(i + 1), edges[i]
            left, right = self._lift(top[a], depth), self._lift(top[b], depth)
            self._join(left, right)
            root[b] = a
            top[a] = left
        last = self._lift(top[find(0)], 0)
        self._close(last)

    def _node(self, depth, of, n, least, children, leaves, inner) -> int:
        self.depth.append(depth)
        self.of.append(of)
        self.n.append(n)
        self.least.append(least)
        self.children.append(children)
        self.leaves.append(leaves)
        self.inner.append(inner)
        self.parent.append(None)
        return len(self.depth) - 1

    def begins(self, node: int) -> bool:
        return not (self.of[node] == 0 and self.depth[node] <= self.before)

    def open(self, node: int) -> bool:
        return not self.begins(node) or (self.ends_block(node) and self.depth[node] <= self.after)

    def ends_block(self, node: int) -> bool:
        """Whether the block's last sequence is below the node."""
        end = self.depth[node] * DIGEST
        return self.keys[-1][:end] == self.keys[self.of[node]][:end] and len(self.keys[-1]) >= end

    def _close(self, node: int) -> None:
        """No more members: add what the node itself saves."""
        if self.depth[node]:
            words = self.words[self.of[node]][self.depth[node] - 1]
            self.inner[node] += (self.n[node] - self.begins(node)) * words

    def _lift(self, node: int, depth: int) -> int:
        """The ancestor of that depth, of which ``node`` is the only child so far."""
        while self.depth[node] > depth:
            self._close(node)
            self.parent[node] = self._node(
                self.depth[node] - 1, self.of[node], self.n[node], self.least[node],
                int(self.begins(node)), self.leaves[node], self.inner[node],
            )
            node = self.parent[node]
        return node

    def _join(self, left: int, right: int) -> None:
        """One node of two for the same sequence; ``left`` stays, with the lesser sequence."""
        self.n[left] += self.n[right]
        self.least[left] = min(self.least[left], self.least[right])
        self.children[left] += self.children[right]
        self.leaves[left] += self.leaves[right]
        self.inner[left] += self.inner[right]
        self.parent[right] = left
        self.depth[right] = -1  # a name of left from now on

    def names(self) -> dict[int, bytes]:
        """Digests that name the open nodes: they are prefixes of the first or the last sequence."""
        ways = [_prefix_names(self.keys[0], self.before), _prefix_names(self.keys[-1], self.after)]
        return {
            v: ways[self.begins(v)][self.depth[v]]
            for v in range(len(self.depth)) if self.depth[v] >= 0 and self.open(v)
        }


def _prefix_names(key: bytes, depth: int) -> list[bytes]:
    state = hashlib.sha256()
    found = [state.digest()]
    for at in range(depth):
        state.update(key[at * DIGEST : (at + 1) * DIGEST])
        found.append(state.copy().digest())
    return found


FOREST = (
    "open boolean, name binary, parent_name binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, part int, block int, ends string"
)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in FOREST.split(", ")]
    kinds = [
        pa.bool_(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.int32(), pa.int32(), pa.string(),
    ]
    for batch in batches:
        for at in range(batch.num_rows):
            row = {c: v[0] for c, v in batch.slice(at, 1).to_pydict().items()}
            forest = Forest(row["convs"], row["keys"], row["words"], row["before"], row["after"])
            alive = [v for v in range(len(forest.depth)) if forest.depth[v] >= 0]
            ends = {}
            for node, i in forest.own.items():
                while forest.depth[node] < 0:
                    node = forest.parent[node]
                ends[node] = ",".join(map(str, forest.members[i]))
            named = forest.names()
            out = []
            for v in alive:
                up = forest.parent[v]
                while up is not None and forest.depth[up] < 0:
                    up = forest.parent[up]
                text = ends.get(v)
                out.append((
                    v in named, named.get(v), named.get(up), forest.least[v], forest.depth[v],
                    None if up is None or up in named else forest.least[up], forest.n[v], forest.children[v],
                    forest.leaves[v], forest.inner[v],
                    None if v in named else hashlib.sha256((text or "").encode()).hexdigest(),
                    row["part"], row["block"], text if v in named else None,
                ))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each run of rows with the same name, whose texts are joined by commas."""
    name, state = None, None

    def done(name, state):
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["name", "ends_sha256"]
        )

    for batch in batches:
        for own, text in zip(batch.column("name"), batch.column("ends")):
            if own.as_py() != name:
                if state is not None:
                    yield done(name, state)
                name, state = own.as_py(), hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.as_buffer())
    if state is not None:
        yield done(name, state)


NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(sequences: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The nodes of the trie over ``conv_id, key, words`` (see ``keyed``; ids unique, not NULL).

    The sequences are sorted over all partitions, equal ones by id, and cut into blocks of
    bounded size. Each block gives a forest of its own; the nodes that it shares with its
    neighbours, which are prefixes of its first or last sequence, are contracted to one
    row each and merged across blocks by their name. Members of a node whose sequence ends
    in several blocks are hashed as one stream of blocks. No table of sequences gives no nodes.
    """
    spark = sequences.sparkSession
    rows = stored(sequences.select("conv_id", "key", "words"), "sequences")
    ordered = rows.repartitionByRange(task_count(spark), "key", "conv_id").sortWithinPartitions("key", "conv_id")
    blocks = stored(ordered.mapInArrow(_blocks(block_turns), BLOCKS), "blocks")
    in_order = Window.orderBy("part", "block")  # one row for each block
    borders = blocks.select(
        "part", "block", F.lag("last").over(in_order).alias("before"), F.lead("first").over(in_order).alias("after")
    )
    joined = blocks.join(borders, ["part", "block"]).select("part", "block", "convs", "keys", "words", "before", "after")
    forests = stored(joined.mapInArrow(_forests, FOREST), "forests")
    pieces = forests.where("open")
    texts = pieces.where("ends is not null").select("name", "part", "block", "ends")
    hashed = texts.repartition("name").sortWithinPartitions("name", "part", "block").mapInArrow(
        _hashed, "name binary, ends_sha256 string"
    )
    merged = pieces.groupBy("name").agg(
        F.first("parent_name").alias("parent_name"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    merged = stored(merged.join(hashed, "name", "left").na.fill(EMPTY_SHA256, ["ends_sha256"]), "merged")
    closed = forests.where("not open")
    inner = closed.where("parent_name is null").select(NODES)
    below = closed.where("parent_name is not null").drop("parent_conv_id").unionByName(merged, allowMissingColumns=True)
    tops = merged.select(F.col("name").alias("parent_name"), F.col("conv_id").alias("parent_conv_id"))
    if merged.count() <= BROADCAST_ROWS:
        known = below.join(F.broadcast(tops), "parent_name", "left")  # at most BROADCAST_ROWS rows
    else:
        known = spread_join(below, tops, ["parent_name"], "left")
    return inner.unionByName(known.select(NODES))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of all rebuilt ``conversations`` (``conv_id, turn, role, text``), a row per node.

    See ``turn_lists`` and ``rebuilt`` for NULLs, ties and repeated rows, which are turns of
    their own; other columns are not read, and an empty table has no nodes, not even the root.
    """
    lists = stored(turn_lists(conversations), "turns")
    return trie(keyed(rebuilt(lists)))
