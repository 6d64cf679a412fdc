"""Many terms at once, each within a few edits of a word of the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingspark.operators.keys import spread_join
from filingspark.operators.text import tokens
from filingspark.session import checkpoint

SHORT_TERM = 24
FUZZINESS = ("0", "1", "2", "AUTO")
BROADCAST_ROWS = 200_000


def edits_allowed(term: Column, fuzziness: str = "AUTO") -> Column:
    """How many edits a term bears: as given, or by its length (none to 2 letters, one to 5, else two)."""
    if fuzziness not in FUZZINESS:
        raise ValueError(f"fuzziness {fuzziness} is not one of {FUZZINESS}")
    if fuzziness != "AUTO":
        return F.lit(int(fuzziness))
    return F.when(F.length(term) <= 2, 0).when(F.length(term) <= 5, 1).otherwise(2)


def deletions(word: Column, edits: int) -> Column:
    """``word`` and all that is left of it when up to ``edits`` of its letters are taken out."""

    def one_less(w: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: i <= F.length(w))
        return F.transform(places, lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))

    found = level = F.array(word)
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, one_less)))
        found = F.concat(found, level)
    return F.array_distinct(found)


def _parts(length: Column, edits: int) -> Column:
    """``(part, start, size)`` of the ``edits + 1`` parts of a term of some length; start counts from 1."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(edits)),
        lambda i: F.struct(
            i.alias("part"),
            (F.floor(i * length / (edits + 1)) + 1).cast("int").alias("start"),
            (F.floor((i + 1) * length / (edits + 1)) - F.floor(i * length / (edits + 1))).cast("int").alias("size"),
        ),
    )


def _near_short(words: DataFrame, terms: DataFrame, edits: int) -> DataFrame:
    """Candidates by equal deletions: two words within n edits share a form of at most n deletions each."""
    forms = words.where(F.length("word") <= SHORT_TERM + edits).select(
        "word", F.explode(deletions(F.col("word"), edits)).alias("form")
    )
    return forms.join(terms.select("term", "edits", F.explode(deletions(F.col("term"), edits)).alias("form")), "form")


def _near_long(words: DataFrame, terms: DataFrame, edits: int) -> DataFrame:
    """Candidates by an untouched part: n edits leave one of n + 1 parts whole, moved by n places at most."""
    size = F.length("term")
    asked = terms.withColumn("long", size).select(
        "term", "edits", "long", F.inline(_parts(size, edits))
    ).select("term", "edits", "long", "part", F.expr("substr(term, start, size)").alias("form"))
    reach = F.sequence(F.lit(-edits), F.lit(edits)) if edits else F.array(F.lit(0))
    held = words.where(F.length("word") > SHORT_TERM - edits).withColumn("_off", F.explode(reach))
    held = held.withColumn("long", F.length("word") + F.col("_off")).select(
        "word", "long", F.inline(_parts(F.col("long"), edits))
    )
    held = held.withColumn("_move", F.explode(reach)).where("start + _move >= 1").select(
        "word", "long", "part", F.expr("substr(word, start + _move, size)").alias("form")
    )
    return held.join(asked, ["long", "part", "form"])


def near_words(words: DataFrame, terms: DataFrame, fuzziness: str = "AUTO") -> DataFrame:
    """``(word, term, distance)`` for distinct ``word`` and ``term`` columns: pairs within the term's edits.

    Short terms meet words by equal deletion forms, long ones by an untouched part; every
    candidate is verified by its edit distance, so the pairs are exact. No word is compared
    with a term it shares nothing with. Empty and NULL terms are near nothing.
    """
    edits = 2 if fuzziness == "AUTO" else int(fuzziness)
    asked = terms.where("term <> ''").withColumn("edits", edits_allowed(F.col("term"), fuzziness))
    shortest, longest = asked.agg(F.min(F.length("term")), F.max(F.length("term"))).first()
    reached = F.length("word").between((shortest or 0) - edits, (longest or 0) + edits)
    words = words.where("word <> ''").where(reached)
    short, long = asked.where(F.length("term") <= SHORT_TERM), asked.where(F.length("term") > SHORT_TERM)
    held = ["word", "term", "edits"]
    met = _near_short(words, short, edits).select(held).union(_near_long(words, long, edits).select(held)).distinct()
    distance = F.levenshtein("word", "term", edits)
    return met.withColumn("distance", distance).where("distance between 0 and edits").drop("edits")


def fuzzy_many(df: DataFrame, key: str, text: str, terms: DataFrame, fuzziness: str = "AUTO") -> DataFrame:
    """``(key, term, words)``: the terms near some word of a text, and by how many distinct words of it.

    ``terms`` has a column ``term``, read in lower case; repeated ones count once. Words are those of
    ``text_match``. Each distinct word of the table is compared once, wherever it occurs; the words
    found then go back to the texts, along with the tasks while they are few, else by a join that
    spreads frequent words. NULL and empty texts have no words; rows that share a key are one text.
    """
    edits_allowed(F.lit(""), fuzziness)
    asked = terms.select(F.lower("term").alias("term")).distinct()
    held = df.select(F.col(key).alias("_key"), F.explode(F.array_distinct(tokens(F.col(text)))).alias("word"))
    near = checkpoint(near_words(held.select("word").distinct(), asked, fuzziness).select("word", "term"))
    if near.count() <= BROADCAST_ROWS:
        hits = held.join(F.broadcast(near), "word")  # at most BROADCAST_ROWS pairs
    else:
        listed = near.groupBy("word").agg(F.collect_list("term").alias("_terms"))
        hits = spread_join(held, listed, ["word"], spread_on=["_key"]).withColumn("term", F.explode("_terms"))
    found = hits.groupBy("_key", "term", "word").agg(F.lit(1).alias("_one"))
    return found.groupBy("_key", "term").agg(F.count("*").alias("words")).withColumnRenamed("_key", key)
