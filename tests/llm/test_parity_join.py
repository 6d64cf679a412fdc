"""Operator 9 against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from filingspark.llm import parity_join as pj
from filingspark.llm.shingles import shingle_sets, slices
from tests.llm import docs


def _result(spark, rows):
    got = pj.components(docs.documents(spark, rows)).collect()
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    rows = docs.corpus(seed)
    texts = {r[0]: r[1] for r in rows}
    group = docs.components(texts)
    assert _result(spark, rows) == sorted((i, len(docs.shingles(t)), group[i]) for i, t in texts.items())


def test_empty_table(spark):
    assert _result(spark, []) == []


def test_repeated_rows_and_null_ids(spark):
    text = "one two three four five six seven"
    rows = [(3, text, None, None, 0), (3, text, None, None, 0), (1, text, None, None, 0)]
    assert _result(spark, rows) == [(1, 3, 1), (3, 3, 1), (3, 3, 1)]
    frame = docs.documents(spark, [(None, text, None, None, 0), (7, text, None, None, 0)])
    got = {(r["doc_id"], r["component_id"]) for r in pj.components(frame).collect()}
    assert got == {(None, None), (7, 7)}


def test_clashing_columns_are_ignored(spark):
    frame = docs.documents(spark).selectExpr("*", "1 as node", "2 as n", "3 as bits", "4 as centre", "5 as key")
    assert pj.components(frame).columns == ["doc_id", "n_shingles", "component_id"]
    assert pj.components(frame).count() == len(docs.corpus())


def test_tiles_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(pj, "TILE_ROWS", 32)
    monkeypatch.setattr(pj, "TILE_SHINGLES", 1)
    draw = random.Random(9)
    centre = draw.choices(docs.LEXICON, k=100)
    rows = []
    for i in range(150):
        copy = list(centre)
        for at in draw.sample(range(100), draw.choice([1, 2, 2, 3])):
            copy[at] = f"w{draw.randrange(50)}"
        rows.append((i, " ".join(copy), "en", "s", 0))
    group = docs.components({r[0]: r[1] for r in rows})
    assert [(a, c) for a, _, c in _result(spark, rows)] == sorted(group.items())


def _sets(texts):
    import pyarrow as pa

    return [s for _, _, d, o in slices(pa.array(texts, pa.string())) for s in shingle_sets(d, o)]


def test_linked_sets_share_a_key():
    """The pigeonhole: at the very edge of a link, some part is met by both."""
    draw = np.random.default_rng(4)
    for size in [*range(1, 60), 97, 250, 1000]:
        for _ in range(6):
            apart = int(draw.integers(0, 2 * size // 9 + 1))
            codes = draw.integers(0, 2**63, size + apart, dtype=np.int64).astype(np.uint64)
            a = np.unique(codes[:size])
            gone = int(draw.integers(0, apart + 1))
            b = np.unique(np.concatenate([codes[gone:size], codes[size : size + apart - gone]]))
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < 80 * (len(a) + len(b) - both):
                continue
            met = [np.concatenate([pj.keys_of([s], step)[1] for step in (0, 1)]) for s in (a, b)]
            assert len(np.intersect1d(*met)), (size, apart, gone)
            near = list(pj.near_in_tile([pj.bits_of(a), pj.bits_of(b)], np.array([len(a), len(b)]), np.zeros(2)))
            assert near


def test_sets_count_words_across_slices():
    texts = ["a b c d e f", None, "", "A B C D E F", "  a\tb\x0bc d e f ", "a b c d", "x" * 9_000_000 + " y"]
    sets = _sets(texts)
    assert [len(s) for s in sets] == [2, 0, 0, 2, 2, 1, 1]
    assert (sets[0] == sets[3]).all() and (sets[0] == sets[4]).all()
