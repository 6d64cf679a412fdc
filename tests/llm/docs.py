"""Small documents with awkward rows, and brute-force versions of what is computed on them."""

from __future__ import annotations

import random
import re

LEXICON = [
    "the", "of", "and", "in", "river", "stone", "light", "window", "green", "paper", "walks", "sings", "under",
    "over", "night", "morning", "bread", "salt", "der", "die", "und", "Haus", "Baum", "geht", "le", "la", "et",
    "maison", "arbre", "marche", "el", "casa", "árbol", "camina", "que", "don't", "A1", "x-y", "日本", "😀",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0d]+", lowered)


def shingles(text: str | None) -> frozenset:
    found = words(text)
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def linked(a: frozenset, b: frozenset) -> bool:
    both = len(a & b)
    return bool(a and b) and 100 * both >= 80 * (len(a) + len(b) - both)


def components(texts: dict[int, str | None]) -> dict[int, int]:
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if linked(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus(seed: int = 5, count: int = 60) -> list[tuple]:
    """Rows of ``SCHEMA``: random texts, chains of near copies, copies, NULL, empty, blank and very long."""
    draw = random.Random(seed)
    rows: list[tuple] = []

    def add(text, lang="en", source="s"):
        rows.append((len(rows), text, lang, source, len(text or "")))

    for i in range(count):
        own = draw.choices(LEXICON, k=draw.choice([1, 2, 3, 4, 5, 6, 9, 20, 60, 200]))
        add(" ".join(own), ["en", "de", None][i % 3], ["a", "b", None, "c"][min(i % 7, 3)])
    base = draw.choices(LEXICON, k=120)
    for i in range(20):  # each linked to its neighbours at most
        for _ in range(draw.choice([0, 1, 2])):
            base[draw.randrange(len(base))] = draw.choice(LEXICON)
        add(" ".join(base).upper() if i % 4 == 3 else "\n".join(base), "en", "b")
    centre = draw.choices(LEXICON, k=150)
    add(" ".join(centre))
    for _ in range(15):  # linked to the centre, often not to each other
        copy = list(centre)
        for at in draw.sample(range(150), 2):
            copy[at] = draw.choice(LEXICON)
        add(" ".join(copy))
    for _ in range(8):
        add("The same text, again and again and again.", "en", "a")
    for text in (None, "", " \n\t ", "...", "1 2 3 4 5 6", "ß", "don't won't I'll", None, "   two  blanks   ", "a'sb 'll"):
        add(text, None, None)
    add(" ".join(draw.choices(LEXICON, k=30_000)), "en", "c")
    add("z" * 100_000, "de", "c")
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA)
