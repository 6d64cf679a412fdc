"""Mentions of names of any characters, found by one automaton over each text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST_NAMES = 200_000
HITS = 50_000


def folded(text: str) -> str:
    """``text`` in lower case, each character in its place: those whose lower form is longer stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def automaton(names: Sequence[tuple[str, str]]) -> ahocorasick.Automaton:
    """All names in one automaton; each knows its length and label."""
    found = ahocorasick.Automaton()
    for name, label in names:
        found.add_word(name, (len(name), label))
    found.make_automaton()
    return found


def occurrences(text: str, names: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """``(start, end, label)`` of the names in a folded text that begin and end at the border of a word.

    Of the names that begin at one place the longest is kept, and none that lies within another.
    """
    longest: dict[int, tuple[int, str]] = {}
    for last, (size, label) in names.iter(text):
        start, end = last + 1 - size, last + 1
        joined_before = start and text[start - 1].isalnum() and text[start].isalnum()
        joined_after = end < len(text) and text[end].isalnum() and text[last].isalnum()
        if not (joined_before or joined_after):
            longest[start] = (end, label)  # ends come in ascending order
    reached, found = 0, []
    for start in sorted(longest):
        end, label = longest[start]
        if end > reached:
            found.append((start, end, label))
            reached = end
    return found


def _found(df: DataFrame, key: str, text: str, names: Sequence[tuple[str, str]]) -> DataFrame:
    schema = f"{key} {dict(df.dtypes)[key]}, start int, end int, text string, label string, _row long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = automaton(names)
        rows = []
        for batch in batches:
            for k, body, row in zip(batch["_key"], batch["_text"], batch["_row"]):
                rows += [(k, a, b, body[a:b], label, row) for a, b, label in occurrences(folded(body), known)]
                if len(rows) >= HITS:
                    yield pd.DataFrame(rows, columns=[key, "start", "end", "text", "label", "_row"])
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=[key, "start", "end", "text", "label", "_row"])

    read = df.where(F.col(text) != "").select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("_row")
    )
    return read.mapInPandas(run, schema)


def named_mentions(
    df: DataFrame, key: str, text: str, gazetteer: DataFrame, most_names: int = MOST_NAMES
) -> DataFrame:
    """``(key, mention_id, text, label, start, end)``: names ``(name, label)`` in the texts, in any case.

    Names may hold blanks and punctuation; where a name begins or ends with a letter or digit,
    its neighbour in the text is none. A mention within a longer one is dropped; mentions that
    merely overlap are kept. A name with several labels has the least, names without characters
    or label are not looked for. ``start`` and ``end`` count characters, end exclusive.

    Names go along with the tasks, at most ``most_names`` of them at a time: a longer list is
    looked up in as many passes over the texts as it has such parts, cut by a hash of the name,
    and the mentions of all passes are compared within their text. NULL and empty texts have none.
    """

    @F.pandas_udf("string")
    def fold(written: pd.Series) -> pd.Series:
        return written.map(folded)

    names = (
        gazetteer.where("name <> '' and label is not null").select(fold("name").alias("_name"), "label")
        .groupBy("_name").agg(F.min("label").alias("label"))
    )
    parts = max(1, -(-2 * names.count() // most_names)) if names.limit(most_names + 1).count() > most_names else 1
    found = None
    for part in range(parts):
        own = names.where(F.pmod(F.xxhash64("_name"), F.lit(parts)) == part)
        known = [tuple(r) for r in own.collect()]  # about half of most_names at a time
        if known:
            hits = _found(df, key, text, known)
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = _found(df, key, text, [("\0", "")]).where(F.lit(False))
    elif parts > 1:
        above = Window.partitionBy(key, "_row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
        found = found.withColumn("_reached", F.max("end").over(above)).where("_reached is null or end > _reached")
    digest = F.sha2(F.concat_ws("|", F.col(key).cast("string"), "start", "end"), 256)
    return found.select(key, digest.alias("mention_id"), "text", "label", "start", "end")
