"""Operator 4 against globs as regular expressions."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np

from filingspark.llm import url_rules
from filingspark.llm.queries import QUERIES, SQL, URL_RULES
from filingspark.llm.url_rules import Automaton, Rule


def as_regex(glob: str) -> re.Pattern:
    out, in_host, at = "", True, 0
    while at < len(glob):
        c = glob[at]
        if c == "\\":
            at += 1
            out += re.escape(glob[at])
            in_host &= glob[at] != "/"
        elif c in "*?":
            out += ("[^/]" if in_host else "[\\s\\S]") + ("*" if c == "*" else "")
        else:
            out += re.escape(c)
            in_host &= c != "/"
        at += 1
    return re.compile(out)


def test_automaton_matches_regular_expressions():
    draw = random.Random(1)
    globs = ["".join(draw.choices("ab/.*?", k=draw.randint(0, 12))) for _ in range(120)]
    globs += ["", "*", "**", "?", "a*b*c", "\\*\\?\\\\", "*/a*/b", "." * 70]
    texts = ["".join(draw.choices("ab/.", k=draw.randint(0, 14))) for _ in range(800)] + ["", "*?\\", "." * 70, "a" * 5000]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    automaton = Automaton(globs)
    assert automaton.words > 1
    found = automaton.match(data, offsets)
    for j, glob in enumerate(globs):
        pattern = as_regex(glob)
        assert [bool(pattern.fullmatch(t)) for t in texts] == found[:, j].tolist(), glob


def plain(url: str | None) -> tuple:
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    rules = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}
    fits = [
        (len(h + p), h + p, v) for (h, p), v in rules.items()
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "://", "HTTP://Example.NET/en/x", "http://a.example.net/en", "http://example.net",
        "http://net/", "http://xnet/", "https://notexample.com/de/", "https://example.com/de/?q#f", "http://ORG/fr/a?b=/c#d",
        "http://a.org?/fr/", "http://user:pw@b.example.com:80/de/", "http://a://b.net/c", "http://é.net/ü", "http://b.net/.example.net/en/",
        "http://x.com/login", "http://x.com/a/b.zip", "http://x.com/a?sessionid=1", "http://x.com/" + "y" * 30_000 + ".zip", "http://b.net#/",
    ]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(0, None, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = url_rules.judge(frame, "url", URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        if rule:
            assert r["verdict"] == verdict
    last = {r["page_id"]: r["verdict"] for r in got}
    assert [last[i] for i in (18, 19, 20, 21, 0, 2)] == ["block"] * 4 + ["allow"] * 2
    assert url_rules.judge(frame.limit(0), "url", URL_RULES).count() == 0


def test_equal_names_block_first(spark):
    frame = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    rules = [Rule("*.b/*", "allow", "same"), Rule("*.b/c", "block", "same"), Rule.of_host("b*", "/c", "allow")]
    assert url_rules.judge(frame, "url", rules).first()["verdict"] == "block"


QUERY_ONLY = [
    "http://a.com?u=b.net/", "http://a.com?u=x.example.net/en/", "http://a.com?u=.example.com/de/", "http://a.com?u=.org/fr/",
    "http://a.com?x=/login", "http://a.com?x=/a.zip", "http://a.net?x=/", "http://a.com?x=/&sessionid=1", "http://a.com?sessionid=1",
    "http://a.com/?u=b.net/&sessionid=1", "http://a.com/?x=/login", "http://a.com/?x=.zip", "http://a.net/?u=.org/fr/", "http://a.com??.net/",
]


def test_rules_do_not_fit_in_the_query(spark):
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(QUERY_ONLY)], "page_id long, url string")
    got = {r["page_id"]: r for r in url_rules.judge(frame, "url", URL_RULES).collect()}
    for i, url in enumerate(QUERY_ONLY):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == plain(url)[:3]
    assert [got[i]["verdict"] for i in range(7)] == ["allow"] * 7
    assert got[0]["globs"] == []


def test_sql_agrees_on_queries_without_a_path(spark, tmp_path):
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(QUERY_ONLY)], "page_id long, url string")
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(duck.execute(SQL["op4_url_rules"]).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op4_url_rules"](spark, str(tmp_path)).collect())
    assert got == want
