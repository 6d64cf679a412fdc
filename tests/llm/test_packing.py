"""Operator 3 against the tokenizer, and its sequences against the rules of packing."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from filingspark.llm import packing
from filingspark.llm.tokens import Encoder, vocabulary_path
from tests.llm import docs


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def test_ids_equal_the_tokenizer(tokenizer):
    draw = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\r\n", "'", "'s", "'ll", "'re", "a", "B", "é", "漢字", "1", "٣", "!", "...",
             " ", " ", "😀", "don't", "I'VE", "<|endoftext|>", "\x1c", "́", "_", "''s", " 's", "\x85"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 14))) for _ in range(5000)]
    texts += [r[1] or "" for r in docs.corpus()]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [list(x) for x in Encoder(vocabulary_path()).ids(pa.array(texts))] == want


def _check(rows, texts, tokenizer):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for k, r in enumerate(sorted(pieces[doc], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["length"] == 1024 or k == 0
            own = np.array(ids[at : at + r["length"]], dtype="<u4")
            assert r["ids_crc32"] == zlib.crc32(own.tobytes())
            at += r["length"]
        assert at == len(ids)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences)


def test_pack(spark, tokenizer):
    rows = docs.corpus()
    frame = docs.documents(spark, rows).selectExpr("*", "1 as length", "2 as task", "3 as nth").repartition(5)
    got = packing.pack(frame).collect()
    used = _check(got, {r[0]: r[1] for r in rows}, tokenizer)
    assert used <= -(-sum(r["length"] for r in got) // 1024) + 2


def test_sequences_hold_the_ids(spark, tokenizer):
    rows = docs.corpus()
    packed = packing.pack(docs.documents(spark, rows).repartition(3), ids=True)
    places = packed.select("doc_id", "piece", "sequence_id", "offset", "length", "ids", "ids_crc32").collect()
    laid = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    whole = defaultdict(list)
    for r in sorted(places, key=lambda r: r["piece"]):
        assert laid[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"]
        whole[r["doc_id"]] += r["ids"]
    texts = tokenizer.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)
    assert whole == {r[0]: [*t.ids, 2] for r, t in zip(rows, texts)}
    assert max(map(len, laid.values())) <= 1024


def test_repeated_rows_and_empty_table(spark):
    one = docs.documents(spark, [(1, "a b", None, None, 3)] * 3 + [(None, None, None, None, None)])
    got = sorted((r["doc_id"] or 0, r["length"], r["offset"]) for r in packing.pack(one).collect())
    assert [g[:2] for g in got] == [(0, 1), (1, 3), (1, 3), (1, 3)]
    assert len({g[2] for g in got}) == 4
    assert packing.pack(docs.documents(spark, [])).count() == 0


def test_plan_is_close_to_the_bound():
    draw = np.random.default_rng(1)
    for count in (1, 7, 300, 50_000):
        lengths = draw.integers(1, 1025, count)
        plan = packing.Plan(Counter(lengths.tolist()))
        assert plan.table()[:, 2].sum() == count
        best_fit = packing.Plan(Counter(lengths.tolist()), small=1025)
        assert plan.sequences <= best_fit.sequences * 1.003 + 1


def test_configurations_fit():
    found = packing.configurations([700, 400, 300], [100, 200, 300], 1024)
    assert all(slots @ np.array([700, 400, 300]) <= 1024 for slots, _ in found)
    assert sum(times for _, times in found) <= 100 + 100 + 100
