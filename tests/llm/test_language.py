"""Operator 2 against sums over all segmentations, and its accuracy on held-out documents."""

from __future__ import annotations

import base64
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from filingspark.llm import language
from tests.llm import docs

ENGLISH = "the river runs under the old stone bridge and the morning light walks over green water with him".split()
GERMAN = "der alte Baum steht hinter dem Haus und die Kinder gehen jeden Morgen durch den grünen Wald".split()


def _labelled(spark, count=300):
    draw = random.Random(2)
    rows = []
    for i in range(count):
        lang, own = (("en", ENGLISH), ("de", GERMAN))[i % 2]
        rows.append((i, " ".join(draw.choices(own, k=draw.randint(3, 30))), lang, "s", 0))
    return docs.documents(spark, rows)


def test_forward_sums_all_segmentations():
    known = language.pieces(language.vocabulary_path())
    ranked = [line.split() for line in open(language.vocabulary_path(), "rb")]
    numbers = {}
    for piece, _ in ranked:
        piece = base64.b64decode(piece)
        if len(piece) <= language.LONGEST_PIECE:
            at = np.searchsorted(known.hashes, np.uint64(known._hash(piece)))
            numbers[piece] = known.start[at]

    def total(word: bytes) -> float:
        return 1.0 if not word else sum(
            numbers.get(word[:k], 0.0) * total(word[k:]) for k in range(1, len(word) + 1)
        )

    for word in (b" the", b" Haus", " ß".encode(), b" zqxj"):
        rows = np.frombuffer(word, dtype=np.uint8)[None, :].astype(np.uint64)
        got = known.forward(rows, np.append(known.start, 0.0)[:, None], known.spans(rows))[-1, 0, 0]
        assert np.isclose(got, total(word), rtol=1e-9)
        assert sum(share[0] for _, share in known.expected(rows)) >= 1.0 - 1e-9  # one piece at least


def test_held_out_accuracy(spark):
    frame = _labelled(spark).withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.learn(frame.where("not held_out"))
    got = language.accuracy(language.identify(frame, model))
    assert (got["accuracy"] > 0.97).all() and set(got["held_out"]) == {True, False}


def test_held_out_is_the_checksum(spark):
    frame = spark.range(200).withColumnRenamed("id", "doc_id")
    rows = frame.select("doc_id", language.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def test_undetermined_and_awkward_rows(spark):
    model = language.learn(_labelled(spark))
    rows = docs.corpus()
    frame = docs.documents(spark, rows).selectExpr("*", "'x' as score", "'y' as lang_pred")
    got = {r["doc_id"]: r for r in language.identify(frame, model).collect()}
    assert len(got) == len(rows)
    for doc, text, *_ in rows:
        lettered = any(c.isalpha() for c in text or "")
        assert (got[doc]["lang_pred"] == "und") == (not lettered)
        assert 0.0 <= got[doc]["score"] <= 1.0


def test_nothing_learnt_and_empty_tables(spark):
    empty = docs.documents(spark, [])
    assert language.learn(empty)[0] == []
    got = language.identify(_labelled(spark, 4), language.learn(empty)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert language.identify(empty, language.learn(_labelled(spark, 20))).count() == 0


def test_model_does_not_depend_on_partitions(spark):
    frame = _labelled(spark)
    first, second = language.learn(frame.repartition(1)), language.learn(frame.repartition(7))
    assert first[0] == second[0] and (first[1] == second[1]).all()


def _log_total(known, word: bytes, chances: np.ndarray) -> float:
    """By log-sum-exp over all segmentations, position by position."""
    logs = [0.0]
    for j in range(1, len(word) + 1):
        terms = []
        for i in range(max(0, j - language.LONGEST_PIECE), j):
            piece = np.uint64(known._hash(word[i:j]))
            at = np.searchsorted(known.hashes, piece)
            if at < known.count and known.hashes[at] == piece:
                terms.append(logs[i] + np.log(chances[at]))
        logs.append(np.logaddexp.reduce(terms))
    return logs[-1]


LONG_RUNS = ["漢字仮名交文" * 8, "ひらがな" * 12, "𐌰𐌱𐌲𐌳" * 30, "abcdefghijklmnopq", "क" * 47 + "b" * 90, "z" * 9000]


def test_long_runs_are_summed_whole_and_in_range():
    known = language.pieces(language.vocabulary_path())
    words = [w.encode() for w in LONG_RUNS]
    rare = language.PRIOR * known.start / 1e12
    seen = set()
    for part, rows, lengths in language._long(words):
        both = np.append(np.stack([known.start, rare], axis=1), np.zeros((1, 2)), axis=0)
        got = known.log_totals(rows, lengths, both)
        for k, i in enumerate(part):
            seen.add(i)
            assert np.isclose(got[k, 0], _log_total(known, b" " + words[i], known.start), rtol=1e-9)
            assert np.isclose(got[k, 1], _log_total(known, b" " + words[i], rare), rtol=1e-9)
        bytes_met = np.zeros(len(part))
        sizes = np.zeros(known.count + 1)
        for length in range(1, language.LONGEST_PIECE + 1):
            for piece in {w[a : a + length] for w in [b" " + x for x in words] for a in range(len(w) - length + 1)}:
                at = np.searchsorted(known.hashes, np.uint64(known._hash(piece)))
                if at < known.count and known.hashes[at] == np.uint64(known._hash(piece)):
                    sizes[at] = length
        for piece, share in known.expected_long(rows, lengths):
            bytes_met += share * sizes[piece]
        assert np.allclose(bytes_met, lengths)  # the pieces of each segmentation cover the word once
    assert seen == set(range(len(words)))


def test_long_runs_of_unseen_scripts_with_large_counts(spark):
    langs, chances = language.learn(_labelled(spark))
    start = language.pieces(language.vocabulary_path()).start
    large = (chances * 1e10 + language.PRIOR * start[:, None]) / (1e10 + language.PRIOR)
    model = langs, np.where(chances > 2 * start[:, None], large, language.PRIOR * start[:, None] / 1e10)
    rows = [(i, run, None, None, 0) for i, run in enumerate(LONG_RUNS)]
    rows.append((len(rows), " ".join([*GERMAN * 200, LONG_RUNS[0], LONG_RUNS[2]]), None, None, 0))
    got = {r["doc_id"]: r for r in language.identify(docs.documents(spark, rows), model).collect()}
    assert all(0.0 <= r["score"] <= 1.0 for r in got.values())
    assert got[len(LONG_RUNS)]["lang_pred"] == "de"


def test_long_runs_are_learnt(spark):
    rows = [(i, run, "x", "s", 0) for i, run in enumerate(LONG_RUNS)]
    langs, chances = language.learn(docs.documents(spark, rows))
    assert langs == ["x"] and (chances > 0).all() and np.isclose(chances.sum(), 1.0)
