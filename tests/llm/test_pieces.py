"""Operator 12 against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from filingspark.llm import pieces
from tests.llm import docs


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(2)
    parts = [" ", "  ", "▁", "a", "th", "the", "ing", "\n", "\t", "é", "日本", "😀", "\x00", "1", "0", "'s", "zz", "Q", "ß",
             "​", "x" * 5, "\x85", "<s>", "<0x41>", "﻿", "　", "\U0010ffff"]
    found = ["".join(draw.choices(parts, k=draw.randint(0, 20))) for _ in range(8000)]
    found += ["a" * (n % 2) + " " * n + "b" * (n % 3) for n in range(80)]
    found += ["z" * 3000, "ab" * 2000, "é" * 999, " " * 1000, "-" * 501, "=" * 500, "the " * 3000, ""]
    return found + [r[1] or "" for r in docs.corpus()]


def _runs(codec, texts):
    ids, decoded = [], []
    for _, flat, offsets in codec.encoded(pa.array(texts)):
        ids += [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
        decoded += [d.decode() for d in codec.decoded(flat, offsets)]
    return ids, decoded


def test_codec_equals_the_library(library, texts, monkeypatch):
    want = library.encode(texts)
    assert _runs(pieces.Codec(pieces.model_path()), texts) == (want, library.decode(want))
    monkeypatch.setattr(pieces, "TEXT_BYTES", 500)
    monkeypatch.setattr(pieces, "KNOWN_BYTES", 3000)
    monkeypatch.setattr(pieces, "LONG_WORD", 4)
    assert _runs(pieces.Codec(pieces.model_path()), texts[:2000]) == (want[:2000], library.decode(want[:2000]))


def test_any_ids_are_decoded_as_by_the_library(library):
    draw = random.Random(4)
    ids = [[draw.randrange(0, draw.choice([5, 300, 32000])) for _ in range(draw.randint(0, 12))] for _ in range(8000)]
    offsets = np.cumsum([0, *map(len, ids)])
    flat = np.array([i for row in ids for i in row], dtype=np.int32)
    found = [d.decode() for d in pieces.Codec(pieces.model_path()).decoded(flat, offsets)]
    assert found == library.decode(ids)


def test_neighbours_merged_anew(library):
    """The rule for neighbours against plain merging, for one pair and for arrays."""
    own, draw = pieces.vocabulary(pieces.model_path()), random.Random(5)
    tokens = [t for t in own.halves if len(own.text[t]) < 7]
    pairs = [(draw.choice(tokens), draw.choice(tokens)) for _ in range(1500)]
    common = [own.number[c] for c in "etaoin▁srh"]
    pairs += [(draw.choice(common), draw.choice(tokens)) for _ in range(500)]
    want = [own._merge(own.text[a] + own.text[b])[0] == [a, b] for a, b in pairs]
    assert [own.together(a, b) for a, b in pairs] == want
    assert own._all_together(*np.array(pairs).T).tolist() == want
    assert True in want and False in want


def test_backtracking_steps_back(library):
    """Words in which the longest beginning is wrong."""
    own = pieces.vocabulary(pieces.model_path())
    words = [t.replace("▁", "") for t in own.text if own.number.get(t) in own.halves][:3000]
    joined = [a + b[:2] for a, b in zip(words, words[1:])]
    greedy = sum(1 for w in joined if w and own.backwards.scan(w)[0] >= 0 and own.tokens(w)[0] != own.backwards.scan(w)[0])
    assert greedy > 20
    ids, sizes = own.tokens_of([w.encode() for w in joined])
    assert [a.tolist() for a in np.split(ids, np.cumsum(sizes)[:-1])] == [own.tokens(w) for w in joined]


def test_queries(spark, library):
    rows = docs.corpus() + [(None, "a b", None, None, 3), (1, None, None, None, None), (1, "a  b", None, None, 4), (1, "a  b", None, None, 4)]
    frame = docs.documents(spark, rows).selectExpr("*", "1 as ids", "2 as n_tokens").repartition(4)
    got = sorted(map(tuple, pieces.digests(frame).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=repr)
    want = []
    for row in rows:
        ids = library.encode(row[1] or "")
        sums = [hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), library.decode(ids))]
        want.append((row[0], len(ids), *sums))
    assert got == sorted(want, key=repr)
    encoded = pieces.encode(frame)
    ids = sorted(((r["doc_id"], r["ids"]) for r in encoded.collect()), key=repr)
    assert ids == sorted(((r[0], library.encode(r[1] or "")) for r in rows), key=repr)
    texts = sorted(((r["doc_id"], r["text"]) for r in pieces.decode(encoded).collect()), key=repr)
    assert texts == sorted(((r[0], (r[1] or "").replace("▁", " ")) for r in rows), key=repr)


def test_empty_table_and_null_ids(spark):
    assert pieces.digests(docs.documents(spark, [])).count() == 0
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted(map(tuple, pieces.decode(rows).collect())) == [(1, ""), (2, "")]
