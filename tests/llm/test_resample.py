"""Operator 11 against zlib and a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from filingspark.llm import crc, resample
from tests.llm import docs


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features(text, longest=2):
    own = words(text)
    return [" ".join(own[i : i + n]) for n in range(1, longest + 1) for i in range(len(own) - n + 1)]


def test_spans_equal_zlib():
    data = np.random.default_rng(0).integers(0, 256, 70_000).astype(np.uint8)
    raw, running = data.tobytes(), crc.Running(data)
    ends = np.array([0, 1, 255, 256, 257, 511, 512, 66_000, 69_999, 70_000])
    assert running.at(ends).tolist() == [zlib.crc32(raw[:e]) for e in ends]
    a, b = np.array([0, 1, 7, 300, 5, 70_000, 100]), np.array([0, 5, 300, 70_000, 66_000, 70_000, 101])
    found = crc.span(running.at(a), running.at(b), b - a)
    assert found.tolist() == [zlib.crc32(raw[i:j]) for i, j in zip(a, b)]
    assert crc.followed(running.at(ends[:-1]), 0x20).tolist() == [zlib.crc32(raw[:e] + b" ") for e in ends[:-1]]
    one = np.full(2, zlib.crc32(b"x"), dtype=np.uint32)
    far = np.array([(1 << 17) + 9, (1 << 24) + 5])
    joined = crc.shifted(one, far) ^ np.array([zlib.crc32(b"\0" * n) for n in far.tolist()], dtype=np.uint32)
    assert joined.tolist() == [zlib.crc32(b"x" + b"\0" * n) for n in far.tolist()]


def test_windows_lose_and_repeat_nothing():
    draw = random.Random(1)
    texts = [r[1] for r in docs.corpus()[::6] if len(r[1] or "") < 2000] + [None, "", "A b  c", "z" * 5000, "a" * 300 + " " + "b" * 300 + " c", " . " * 900, "1 2 3 4 5 6"]
    texts.append(" ".join(draw.choices(["aa", "b", "CC", "日本", "1"], k=800)))
    for longest in (1, 3):
        for most in (17, 400, 1 << 20):
            found = [[] for _ in texts]
            for first, data, offsets, known in resample.windows(pa.array(texts), longest, most):
                at, runs = resample.grams(data, offsets, longest)
                for k in range(len(at) - 1):
                    for value, valid in runs:
                        own = slice(max(at[k], known), max(at[k + 1], known))
                        found[first + k] += value[own][valid[own]].tolist()
            for text, own in zip(texts, found):
                if len(text or "") <= 20_000 or most > 100:
                    assert Counter(own) == Counter(zlib.crc32(f.encode()) for f in features(text, longest))


def plain(rows, target, percent=25, buckets=10_000):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t))

    s, t = counts([r[1] for r in rows]), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets))))
        for b in range(buckets)
    ]
    out = []
    for doc, text in [(r[0], r[1]) for r in rows]:
        own = [gain[zlib.crc32(f.encode()) % buckets] for f in features(text)]
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(own) // len(own) if own else 0
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc, len(words(text)), len(own), weight, score))
    fit = sorted([r for r in out if r[1] >= 20], key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    drawn = Counter()
    ranks = []
    for k, r in enumerate(fit[: len(fit) * percent // 100], 1):
        ranks.append((*r, k))
        drawn[r] += 1
    for r in out:
        if drawn[r]:
            drawn[r] -= 1
        else:
            ranks.append((*r, None))
    return sorted(ranks, key=repr)


def _rows(df):
    names = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def test_resample(spark):
    rows = docs.corpus()
    rows += [(None, rows[5][1], None, None, 1), (None, None, None, None, None), (7, "the of and " * 30, None, None, 1)] * 3
    target = ["the of and in river stone", None, "", "der die und"]
    frame = docs.documents(spark, rows).selectExpr("*", "1 as rank", "2 as bucket", "'x' as n", "3 as at").repartition(5)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, n int")
    got = resample.resample(frame, benchmark)
    assert _rows(got) == plain(rows, target)


def test_empty_tables(spark):
    none, some = docs.documents(spark, []), docs.documents(spark, [(1, "a b c " * 10, None, None, 60), (2, None, None, None, None)])
    assert resample.resample(none, some).count() == 0
    assert _rows(resample.resample(some, none, percent=100)) == plain([(1, "a b c " * 10), (2, None)], [], percent=100)
