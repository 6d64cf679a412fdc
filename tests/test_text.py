from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingspark.operators import similarity as S
from filingspark.operators import text as X
from filingspark.sources import tables as store


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")


def strings(spark, html):
    return docs(spark, html).select(X.html_strings(F.col("text"))).first()[0]


def test_html(spark):
    assert strings(spark, "<p>no bold</p>") == []
    assert strings(spark, "<br><body>x<b>Head</b> <i>a&nbsp;b c​d</i>\n<p>&lt;x&gt; &amp;amp;</p></body>") == [
        "Head", "a b c d", "<x> &amp;",
    ]
    assert strings(spark, "<script>var b='<b>no</b>'</script><B class='q'>yes<!-- <i>hid</i> --><style>p{}</style> \t</B>") == ["yes"]


def test_entities(spark):
    text = "<b>x</b>A&#8217;s &#x2019; &mdash; &eacute;&amp;eacute; &#151; &#0; &#55296; &bogus; & &; AT&T &#128512;"
    assert strings(spark, text) == ["x", "A\u2019s \u2019 \u2014 é&eacute; \u2014 \ufffd \ufffd &bogus; & &; AT&T \U0001f600"]


def test_pages_without_header(spark):
    page = "<p>note: one</p>\n<p>a:b</p>\n" * 20_000
    assert X.sgml_header(docs(spark, page, None, ""), "id", "text").count() == 0


HEADER = (
    "<SEC-HEADER>\nACCESSION NUMBER:\t\t0001\nFILER:\n\n\tCOMPANY DATA:\t\n\t\tNAME:\t\t\tA: B\n"
    "\tFORMER COMPANY:\n\t\tOLD:\tx\n\tFORMER COMPANY:\n\t\tOLD:\ty\n\tFORMER COMPANY:\n\t\tOLD:\tz\n"
    "\t\t\t\tDEEP:\tq\nplain line\n</SEC-HEADER>\nAFTER:\t1"
)


def test_header(spark):
    found = X.sgml_header(docs(spark, HEADER, "FILER:\n\tX:\t1", "nothing"), "id", "text").orderBy("id", "pos").collect()
    assert [(r.path, r.level, r.value) for r in found if r.id == 0] == [
        ("ACCESSION NUMBER", 0, "0001"), ("FILER", 0, ""), ("FILER/COMPANY DATA", 1, ""),
        ("FILER/COMPANY DATA/NAME", 2, "A: B"), ("FILER/FORMER COMPANY", 1, ""), ("FILER/FORMER COMPANY/OLD", 2, "x"),
        ("FILER/FORMER COMPANY2", 1, ""), ("FILER/FORMER COMPANY2/OLD", 2, "y"), ("FILER/FORMER COMPANY3", 1, ""),
        ("FILER/FORMER COMPANY3/OLD", 2, "z"), ("FILER/FORMER COMPANY3/OLD/DEEP", 4, "q"),
    ]
    assert [r.path for r in found if r.id == 1] == ["FILER", "FILER/X"]  # nothing leaks from the first
    assert [r for r in found if r.id == 2] == []


def test_fixed_chunks_rebuild_the_text(spark):
    text = "é\n" * 1000 + "tail"
    pieces = X.chunk_fixed(docs(spark, text, ""), "id", "text", 768).orderBy("chunk").collect()
    assert "".join(p.content for p in pieces) == text
    assert [len(p.content) for p in pieces] == [768, 768, 468]


@pytest.mark.parametrize("seed", range(5))
def test_recursive_chunks(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["word ", "line\n", "par\n\n", "x" * rng.randint(1, 60)]) for _ in range(400))
    pieces = X.split_text(text, 50)
    assert all(0 < len(p) <= 50 for p in pieces)
    assert "".join("".join(pieces).split()) == "".join(text.split())


def test_recursive_prefers_coarse_cuts():
    assert X.split_text("aaa bbb\n\nccc ddd", 8) == ["aaa bbb", "ccc ddd"]
    assert X.split_text("aaaa bbbb", 5) == ["aaaa", "bbbb"]
    assert X.split_text("", 5) == [] and X.split_text("abcdef", 4) == ["abcd", "ef"]


def test_header_runs_without_python(spark):
    out = X.sgml_header(docs(spark, "a b\n\tX:\t1"), "id", "text")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def _header_rows(block):
    """The rows of a header block by a plain loop."""
    rows, above, seen = [], [], {}
    for line in re.split(r"\r?\n", block):
        if ":" not in line:
            continue
        level = len(line) - len(line.lstrip("\t"))
        cells = line[level:].split("\t")
        name = cells[0].replace(":", "").strip(" ")
        above = [a for a in above if a[0] < level]
        parent = "/".join(key for _, key in above)
        seen[parent, name] = seen.get((parent, name), 0) + 1
        key = f"{name}{seen[parent, name]}" if seen[parent, name] > 1 and "FORMER COMPANY" in name else name
        above.append((level, key))
        rows.append((f"{parent}/{key}" if parent else key, level, key, cells[-1] if len(cells) > 1 else ""))
    return rows


def test_header_against_a_plain_loop(spark):
    rng = random.Random(5)
    names = ["A:", "B C:", "FORMER COMPANY:", " FORMER COMPANY : x", "none", ":", "", "D:\t\t1", "E:\tv:w\t2"]
    blocks = [
        rng.choice(["\n", "\r\n"]).join("\t" * rng.randrange(4) + rng.choice(names) for _ in range(rng.choice([1, 8, 2500])))
        for _ in range(30)
    ]
    df = docs(spark, *[f"<SEC-HEADER>{b}</SEC-HEADER>" for b in blocks])
    got = df.select("id", X.header_tree(F.col("text")).alias("rows")).orderBy("id").collect()
    assert [[tuple(r) for r in row.rows] for row in got] == [_header_rows(b) for b in blocks]


def test_match(spark):
    df = docs(spark, "The quick fox", "quick dogs", "lazy", "Quikc").withColumn("title", F.lit("Fox news"))
    ids = lambda **k: sorted(r.id for r in X.text_match(df, ["text"], **k).collect())
    assert ids(query="quick fox", operator="and") == [0]
    assert ids(query="quick fox") == [0, 1]
    assert ids(query="quick", fuzziness="AUTO") == [0, 1] and ids(query="quick", fuzziness="2") == [0, 1, 3]
    assert ids(query="...") == [] and ids(query="...", zero_terms="all") == [0, 1, 2, 3]
    assert X.text_match(df, ["text", "title"], "fox").count() == 4


def test_search_forms(spark):
    df = docs(spark, "quick fox", "dog", "fox")
    ids = lambda q: sorted(r.id for r in X.search(df, q).collect())
    assert ids({"match_all": {}}) == [0, 1, 2] and ids({"match_none": {}}) == []
    assert ids({"term": {"text": "fox"}}) == [2] and ids({"match": {"text": "fox"}}) == [0, 2]
    assert ids({"match": {"text": {"query": "fox quick", "operator": "and"}}}) == [0]
    assert ids({"match": {"text": {"query": "!", "zero_terms_query": "all"}}}) == [0, 1, 2]
    assert ids({"simple_query_string": {"query": "dog quick", "fields": ["text"]}}) == [0, 1]
    with pytest.raises(ValueError):
        X.search(df, {"other": {"a": 1}})


def test_mentions_and_pairs(spark):
    df = docs(spark, "Apple Inc sued Acme; apple lost.", "Acme", "")
    names = spark.createDataFrame([("apple inc", "ORG"), ("Apple", "ORG"), ("ACME", "ORG"), ("Acme", "ORG")], "name string, label string")
    found = X.mentions(df, "id", "text", names, max_words=2)
    spans = sorted((r.id, r.start, r.end, r.text) for r in found.collect())
    assert spans == [(0, 0, 5, "Apple"), (0, 0, 9, "Apple Inc"), (0, 15, 19, "Acme"), (0, 21, 26, "apple"), (1, 0, 4, "Acme")]
    single = X.mentions(df, "id", "text", names)
    pairs = X.entity_pairs(single, df, "id", "text").collect()
    assert sorted(p.snippet for p in pairs) == ["", "Inc sued"]


def test_chat_blocks(spark):
    turns = spark.createDataFrame([(1, t, "user", f"m{t}") for t in range(70)], "conv_id int, turn int, role string, text string")
    blocks = X.chat_history(turns, 32).orderBy("block").collect()
    assert "\n".join(b.history for b in blocks) == "\n".join(f"user: m{t}" for t in range(70))


def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id bigint, v array<float>")


def clustered(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 8))
    points = centres[rng.integers(0, 12, n)] + rng.normal(scale=0.25, size=(n, 8))
    points[: n // 3] = points[0]  # a third are copies
    return np.round(points, 3)


def brute(points, threshold):
    unit = points.astype(np.float32).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    first = {}
    reps = [first.setdefault(tuple(p.astype(np.float32)), i) for i, p in enumerate(points)]
    similar = unit @ unit.T
    pairs = {(i, j) for i in range(len(points)) for j in range(i) if reps[i] == i and reps[j] == j and similar[i, j] > threshold}
    return pairs | {(i, r) for i, r in enumerate(reps) if i != r}


@pytest.mark.parametrize("threshold", [0.9, 0.4])
def test_similarity_join_over_many_cells(spark, monkeypatch, threshold):
    monkeypatch.setattr(S, "ROWS_PER_CELL", 20)
    monkeypatch.setattr(S, "TILE_ROWS", 16)
    points = clustered(1, 300)
    df = vectors(spark, points)
    want = brute(points, threshold)
    found = [(r.id_a, r.id_b) for r in S.similar_pairs(df, "id", "v", threshold).collect()]
    assert len(found) == len(set(found)) and set(found) == want
    parent = list(range(300))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in sorted(want):
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    linked = {x for pair in want for x in pair}
    groups = {r.id: r.group_id for r in S.similarity_groups(df, "id", "v", threshold).collect()}
    assert groups == {i: root(i) if i in linked else None for i in range(300)}


@pytest.mark.parametrize("threshold", [0.9, 0.4])
def test_similarity_join_over_two_levels(spark, monkeypatch, threshold):
    monkeypatch.setattr(S, "ROWS_PER_CELL", 20)
    monkeypatch.setattr(S, "TILE_ROWS", 16)
    monkeypatch.setattr(S, "LEVEL_ANCHORS", 3)
    points = np.concatenate([clustered(2, 400), np.zeros((2, 8))])
    with np.errstate(invalid="ignore"):
        want = brute(points, threshold)
    found = [(r.id_a, r.id_b) for r in S.similar_pairs(vectors(spark, points), "id", "v", threshold).collect()]
    assert len(found) == len(set(found)) and set(found) == want
    rows = vectors(spark, np.unique(points, axis=0)).withColumnRenamed("v", "vec")
    cells = S._cells(rows, threshold).groupBy("cell").agg(F.countDistinct("sub").alias("subs")).collect()
    assert len(cells) <= 3 and max(r.subs for r in cells) > 1


def test_many_anchors_fit_in_memory():
    anchors = np.random.default_rng(3).normal(size=(S.LEVEL_ANCHORS, 64))
    anchors /= np.linalg.norm(anchors, axis=1, keepdims=True)
    tracemalloc.start()
    placed = list(S._placer(anchors, 0.9)(anchors))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(own.sum() for _, _, own in placed) == len(anchors)
    assert peak < 200e6  # a difference in three dimensions takes over 500 MB


def test_components_of_a_long_chain(spark):
    chain = spark.range(200).select((F.col("id") + 1).alias("id_a"), F.col("id").alias("id_b"))
    star = spark.range(1001, 1300).select(F.col("id").alias("id_a"), F.lit(1000).cast("bigint").alias("id_b"))
    found = {r.id: r.group_id for r in S.connected_components(chain.unionByName(star)).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}


def test_chain_below_threshold_is_one_group(spark):
    angles = np.radians([0, 30, 60, 180])
    df = vectors(spark, np.stack([np.cos(angles), np.sin(angles)], axis=1))
    groups = {r.id: r.group_id for r in S.similarity_groups(df, "id", "v", 0.8).collect()}
    assert groups == {0: 0, 1: 0, 2: 0, 3: None}


def test_knn_metrics(spark):
    df = vectors(spark, [[1, 0], [0, 1], [3, 3], [0, 0]])
    best = S.knn(df, "v", {"q": [1.0, 0.1]}, 2, "id").orderBy("rank").collect()
    assert [r.id for r in best] == [0, 2]
    near = S.knn(df, "v", {"q": [0.0, 0.2]}, 1, "id", metric="L2").collect()
    assert [r.id for r in near] == [3]
    assert S.knn(df, "v", {"q": [1.0, 0.0]}, 9, "id", min_score=0.5).count() == 2


def encode(texts):
    if any(not t for t in texts):
        raise ValueError("empty")
    return [[float(len(t))] for t in texts]


def test_failure_routing(spark):
    df = docs(spark, "abc", "", "de")
    good, failed = store.route_failures(store.enrich(df, ["text"], encode))
    assert sorted((r.id, r.text_embedding) for r in good.collect()) == [(0, [3.0]), (2, [2.0])]
    assert [(r.id, r.error) for r in failed.collect()] == [(1, "empty")]


def test_embedding(spark):
    df = docs(spark, "one two", "two three")
    found = S.embed_with(df, "text", lambda: encode).orderBy("id").collect()
    assert [r.embedding for r in found] == [[7.0], [9.0]]
    with pytest.raises(Exception, match="empty text"):
        S.embed_with(docs(spark, " "), "text", lambda: encode).collect()
    hashed = S.embed_hashed(df.unionByName(docs(spark, "four").withColumn("id", F.lit(9).cast("bigint"))), "text", 32)
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-5 for r in hashed.collect())


@pytest.mark.parametrize("levels", [1024, 3])
def test_every_pair_of_copies(spark, monkeypatch, levels):
    monkeypatch.setattr(S, "ROWS_PER_CELL", 20)
    monkeypatch.setattr(S, "TILE_ROWS", 16)
    monkeypatch.setattr(S, "LEVEL_ANCHORS", levels)
    monkeypatch.setattr(S, "COPIES_PER_ROW", 4)
    monkeypatch.setattr(S, "PAIRED_ROWS", 5)
    points = np.concatenate([clustered(4, 240), np.zeros((3, 8))]).astype(np.float32).astype(np.float64)
    ids = [*range(242), 7]  # a row comes twice, and one id has two vectors
    rows = [*zip(ids, points), (3, points[3])]
    held = Counter((i, tuple(v)) for i, v in rows)
    with np.errstate(invalid="ignore"):
        unit = np.array([v for _, v in held]) / np.linalg.norm([v for _, v in held], axis=1, keepdims=True)
    similar, want = unit @ unit.T, Counter()
    for i, (a, v) in enumerate(held):
        for j, (b, w) in enumerate([*held][:i]):
            if a != b and (v == w or similar[i, j] > 0.8):
                want[max(a, b), min(a, b)] += held[max((a, v), (b, w))] if v == w else 1
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id long, v array<float>")
    found = S.every_pair(df.unionByName(spark.createDataFrame([(None, [1.0] * 8), (900, None)], df.schema)), "id", "v", 0.8)
    assert Counter((r.id_a, r.id_b) for r in found.collect()) == want
    assert sum(want.values()) > 80 * 79 / 2
