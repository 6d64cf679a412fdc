"""Operator 13 against a plain trie, for any cut into blocks."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from filingspark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = prefix_trie.NODES


def plain(rows):
    """Nodes of ``(conv_id, turn, role, text)`` rows."""
    lists = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            lists[c].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[3] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in lists.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    return nodes({c: (seq, [len(re.findall(r"[^\x20\x09-\x0D]+", t[1])) for t in seq]) for c, seq in built.items()})


def nodes(sequences):
    members, words, children = defaultdict(list), {}, defaultdict(set)
    for c in sorted(sequences):
        seq, sizes = sequences[c]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            words[tuple(seq[:d])] = sizes[d - 1] if d else 0
            if d:
                children[tuple(seq[: d - 1])].add(tuple(seq[:d]))
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        saved[node] = (len(members[node]) - 1) * words[node] + sum(saved[b] for b in below)
    return sorted(
        (
            members[n][0], len(n), members[n[:-1]][0] if n else -1, len(members[n]), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(str(c) for c in members[n] if len(sequences[c][0]) == len(n)).encode()).hexdigest(),
        )
        for n in members
    )


def _found(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in NAMES) for r in df.collect())


def _random(seed, count, letters="abc", longest=6):
    draw = random.Random(seed)
    return {c: "".join(draw.choices(letters, k=draw.randint(0, longest))) for c in draw.sample(range(1000), count)}


@pytest.mark.parametrize("turns", [1, 3, 10, 100_000])
def test_blocks_of_any_size(spark, turns):
    texts = _random(turns, 150) | {2000 + i: "abcab" for i in range(60)} | {3000 + i: "abcabc" for i in range(20)}
    sequences = {c: (list(t), [ord(x) - 96 for x in t]) for c, t in texts.items()}
    rows = [
        (c, b"".join(hashlib.md5(x.encode()).digest() for x in t), sizes) for c, (t, sizes) in sequences.items()
    ]
    frame = spark.createDataFrame(rows, "conv_id long, key binary, words array<long>").repartition(3)
    assert _found(prefix_trie.trie(frame, turns)) == nodes(sequences)


def test_merged_nodes_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BROADCAST_ROWS", 0)
    texts = _random(9, 200)
    rows = [(c, b"".join(hashlib.md5(x.encode()).digest() for x in t), [1] * len(t)) for c, t in texts.items()]
    frame = spark.createDataFrame(rows, "conv_id long, key binary, words array<long>")
    assert _found(prefix_trie.trie(frame, 5)) == nodes({c: (list(t), [1] * len(t)) for c, t in texts.items()})


def _conversations(seed=3):
    draw = random.Random(seed)
    rows = []
    for c in [*range(130), 400, 1001]:
        if c % 11 == 7:
            continue  # among them first ones of a group
        if c in (40, 60):
            continue
        for turn in range(draw.randint(1, 7)):
            text = draw.choice(["hello there", "yes", "no \t no", "", None, "a b\nc", "ünï ", "x" * 50_000])
            rows.append((c, draw.choice([turn, turn, None]) if c % 5 == 0 else turn, draw.choice(["user", "assistant", None]), text))
    rows += [rows[4]] * 3 + [(None, 1, "user", "nobody's"), (None, None, None, None), (7, None, None, None)]
    return rows


def test_conversations(spark):
    rows = _conversations()
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as turns", "2 as key", "'w' as words", "0 as depth")
    assert _found(prefix_trie.prefix_trie(frame.repartition(4))) == plain(rows)


def test_long_conversation(spark):
    rows = [(c, t, "user", str(t if c == 1 or t < 400 else -t)) for c in (1, 21) for t in range(500)]
    found = _found(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert found == plain(rows) and len(found) > 500


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    turnless = [(21, 0, "user", "a")]  # its first turn would come from conversation 20
    assert _found(prefix_trie.prefix_trie(spark.createDataFrame(turnless, SCHEMA))) == plain(turnless)
