"""The pipeline's stages against brute force, and the registered SQL twins."""

from __future__ import annotations

import os
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tests.llm import docs

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_language_stage_keeps_known_languages(spark):
    rows = docs.corpus(count=150)
    frame = docs.documents(spark, rows)
    kept = pipeline.language_id(spark, frame, "")
    assert kept.columns == COLUMNS
    assert not _rows(kept) - _rows(frame)
    ids = {r["doc_id"] for r in kept.collect()}
    assert not any(r[0] in ids for r in rows if not any(c.isalpha() for c in r[1] or ""))
    assert len(ids) > 100


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    rows = docs.corpus()
    group = docs.components({r[0]: r[1] for r in rows})
    extra = [rows[0], rows[3], (None, rows[0][1], None, None, 0), (None, None, None, None, 0)]
    kept = pipeline.near_duplicates(spark, docs.documents(spark, [*rows, *extra]), "")
    assert kept.columns == COLUMNS
    want = Counter(r for r in rows if group[r[0]] == r[0]) + Counter(extra[2:])
    assert _rows(kept) == want


def test_mixture_stage_repeats_what_the_mix_takes(spark):
    rows = [(i, " ".join(["w"] * (5 + i % 7)), "en", "abc"[min(i % 5, 2)], 0) for i in range(400)] + [(None, None, None, None, 0)]
    mixed = pipeline.mixture(spark, docs.documents(spark, rows), "")
    assert mixed.columns == COLUMNS
    size, got = defaultdict(int), defaultdict(int)
    for r in rows:
        size[r[3]] += len(docs.words(r[1]))
    for r in mixed.collect():
        got[r["source"]] += len(docs.words(r["text"]))
    assert not set(_rows(mixed)) - set(rows)
    assert max(_rows(mixed).values()) <= 3
    from tests.llm.test_mixing import water

    for source, target in water(size).items():
        assert abs(got[source] - target) <= 12


def test_run(spark, tmp_path):
    os.makedirs(tmp_path / "t")
    docs.documents(spark).write.parquet(str(tmp_path / "t/documents.parquet"))
    got = pipeline.run(spark, str(tmp_path / "t"))
    assert "sequence_id" in got.columns and got.count() > 50
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "mixture", "packing"]
    docs.documents(spark, []).write.parquet(str(tmp_path / "e/documents.parquet"))
    assert pipeline.run(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("number", range(1, 11))
def test_one_query_per_operator(number):
    assert sum(name.startswith(f"op{number}_") for name in entry.queries()) == 1
    assert "pipeline" in entry.queries()
