"""Operator 1: SpotSigs fingerprints, and near duplicates by pruned Jaccard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingspark.llm.tables import bind, place, stored, task_count

CHAIN = 2
DISTANCE = 1

# Common words that anchor signatures, by language.
ANCHORS = {
    "en": "a an and are as at be but by for from had has have he her his in is it its not of on or "
    "she that the their they this to was were which will with you",
    "de": "als am auch auf aus bei das dass dem den der des die ein eine einen einer er es für hat "
    "ich im in ist mit nach nicht sich sie sind um und von war werden wie wird zu zum zur",
    "fr": "à au aux avec ce cette dans de des du elle en est et il ils la le les leur mais ne nous "
    "on ou par pas pour qu que qui sa se ses son sur un une vous",
    "es": "al como con de del el ella en entre es está este fue ha la las le lo los más no o para "
    "pero por que se sin su sus también un una y ya",
}


def anchor_words() -> list[str]:
    return sorted({w for words in ANCHORS.values() for w in words.split()})


def signatures(text: Column, chain: int = CHAIN, distance: int = DISTANCE) -> Column:
    """The sorted set of hashed signatures of a text, all inside its row.

    Words are runs of letters and digits in lower case. At each anchor, the next
    ``chain`` content words (those that are no anchors), ``distance`` apart, form a
    signature with it; a chain cut short by the end of the text gives none. With k
    anchors before the p-th word there are p - k content words before it, so the chain
    is read off the list of content words without a search. A text with no whole
    chain has one signature for the sequence of its words, or, without words, for
    the text itself; an empty or NULL text has none.
    """
    anchors = anchor_words()
    reach = (chain - 1) * distance

    def spots(words: Column) -> Column:
        content = F.filter(words, lambda w: ~w.isin(anchors))
        marked = F.filter(
            F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
            lambda s: s["w"].isin(anchors),
        )
        return bind(content, lambda c: bind(F.size(c), lambda n: F.transform(
            F.filter(
                F.transform(marked, lambda s, k: F.struct(s["w"].alias("w"), (s["i"] - k).alias("at"))),
                lambda s: s["at"] + reach < n,
            ),
            lambda s: F.xxhash64(s["w"], *[F.get(c, s["at"] + step * distance) for step in range(chain)]),
        )))

    def whole(words: Column) -> Column:
        return F.when(F.size(words) > 0, F.array(F.xxhash64(F.lit("words"), F.concat_ws(" ", words)))).otherwise(
            F.array(F.xxhash64(F.lit("text"), text))
        )

    cut = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    found = bind(cut, lambda words: bind(spots(words), lambda s: F.when(F.size(s) > 0, s).otherwise(whole(words))))
    none = F.array().cast("array<bigint>")
    return F.when(text.isNull() | (text == ""), none).otherwise(F.sort_array(F.array_distinct(found)))


def fingerprint(found: Column) -> Column:
    """The set of signatures as text: its size, and 128 bits that stand for its members."""
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(seed), found)), 16, "0") for seed in (1, 2)]
    return F.concat(F.size(found).cast("string"), F.lit("-"), *halves)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets; two empty sets are alike.

    Pruned: sets are only met if they overlap at all by their ranges of hashes.
    """
    m, n = F.size(a), F.size(b)
    apart = (F.get(a, m - 1) < F.get(b, F.lit(0))) | (F.get(b, n - 1) < F.get(a, F.lit(0)))
    met = F.size(F.array_intersect(a, b))
    return (
        F.when((m == 0) & (n == 0), F.lit(1.0))
        .when((m == 0) | (n == 0) | apart, F.lit(0.0))
        .when(a == b, F.lit(1.0))
        .otherwise(bind(met, lambda both: both / (m + n - both)))
    )


def _bands(longest: int, threshold: float) -> list[int]:
    """Least lengths of the partitions: each reaches to the length that ``threshold`` allows."""
    least = [1]
    while least[-1] <= longest:
        least.append(int(least[-1] / threshold) + 1)
    return least


def near_duplicates(documents: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``(members, pairs)`` for rows ``doc_id, signatures``.

    ``members`` gives each document its class of equal sets (the least id; NULL ids
    sort first); ``pairs`` holds ``a, b, likeness`` for classes at least
    ``threshold`` alike, a < b. Sets are partitioned by length so that partners lie in
    the same or the next partition; inside, a set is met only through its rarest
    signatures, as many as a partner could miss, and pairs whose lengths rule the
    threshold out are dropped before their sets are compared. Empty sets pair with
    nothing.
    """
    sets = documents.withColumn("_set", F.xxhash64("signatures"))
    key = ["_set", F.size("signatures").alias("n")]
    classes = stored(
        sets.groupBy(*key).agg(F.min("doc_id").alias("class_id"), F.first("signatures").alias("signatures")),
        "classes",
    )
    members = sets.join(classes.select("_set", "n", "class_id"), (sets["_set"] == classes["_set"]) & (
        F.size(sets["signatures"]) == classes["n"]
    )).select("doc_id", "class_id")
    filled = classes.where("n > 0 and class_id is not null")
    longest = filled.agg(F.max("n")).first()[0] or 0
    bands = _bands(longest, threshold)
    each = filled.select("class_id", "n", F.explode("signatures").alias("s"))
    counts = each.groupBy("s").agg(F.count("*").alias("df"))
    by_rarity = Window.partitionBy("class_id").orderBy("df", "s")
    rank = F.row_number().over(by_rarity)
    prefix = each.join(counts, "s").withColumn("_r", rank).where(
        F.col("_r") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1
    )
    own = place(F.col("n"), bands)
    left = prefix.select(F.col("class_id").alias("a"), "s", F.col("n").alias("n_a"), own.alias("band"))
    right = prefix.select(
        F.col("class_id").alias("b"), "s", F.col("n").alias("n_b"),
        F.explode(F.array(own, own - 1)).alias("band"),
    )
    met = (
        left.join(right, ["band", "s"])
        .where("a <> b and n_a <= n_b")
        .where((F.col("n_a") < F.col("n_b")) | (F.col("a") < F.col("b")))
        .where(F.col("n_a") >= F.col("n_b") * threshold)
        .select("a", "b")
        .distinct()
    )
    held = filled.select("class_id", "signatures")
    first = held.select(F.col("class_id").alias("a"), F.col("signatures").alias("s_a"))
    second = held.select(F.col("class_id").alias("b"), F.col("signatures").alias("s_b"))
    scored = met.join(first, "a").join(second, "b").withColumn("likeness", likeness(F.col("s_a"), F.col("s_b")))
    pairs = scored.where(F.col("likeness") >= threshold).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness"
    )
    return members, pairs


def with_next(docs: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Adds ``_next``: ``columns`` of the row with the next ``key``, of the first after the last.

    Splitters of the keys cut the table into runs of near equal length; a row whose
    key opens a run is also sent to the run before it, so that each run knows its
    successor and rows travel once. The columns ``_run`` and ``_guest`` and the order
    within the run stay, for further windows over ``run_order``. NULL keys come last;
    rows with equal keys go by ``columns``.
    """
    runs = 4 * task_count(docs.sparkSession)
    at = [i / runs for i in range(runs)]
    cuts = docs.agg(F.percentile_approx(key, at, 20 * runs + 10_000)).first()[0] or []
    bounds = sorted(set(cuts))
    many = max(1, len(bounds))
    run = F.greatest(place(F.col(key), bounds) - 1, F.lit(0))
    opens = F.array_contains(F.array(*[F.lit(b) for b in bounds]), F.col(key)) if bounds else F.lit(False)
    places = F.when(
        opens & F.lit(many > 1),
        F.array(
            F.struct(run.alias("run"), F.lit(0).alias("guest")),
            F.struct(F.pmod(run - 1, F.lit(many)).alias("run"), F.lit(1).alias("guest")),
        ),
    ).otherwise(F.array(F.struct(run.alias("run"), F.lit(0).alias("guest"))))
    spread = docs.withColumn("_place", F.explode(places)).withColumns(
        {"_run": F.col("_place.run"), "_guest": F.col("_place.guest")}
    ).drop("_place")
    order = run_order(key, columns)
    row = F.struct(*columns)
    return spread.withColumn("_next", F.coalesce(F.lead(row).over(order), F.first(row).over(order)))


def run_order(key: str, columns: list[str]):
    return Window.partitionBy("_run").orderBy("_guest", F.asc_nulls_last(key), *columns)


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last half (rounded down) replaced by as much of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each whole text, of its edited form, and their likeness.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_signatures``. A NULL text counts as empty; an empty
    table gives no rows; repeated rows follow one another; other columns are ignored.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    followed = with_next(texts, "doc_id", ["text"])
    changed = edited(F.col("text"), F.col("_next.text"))
    signed = followed.select(
        "doc_id", "_run", "_guest", "text",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(changed, 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("own"),
        signatures(changed).alias("other"),
    )
    order = run_order("doc_id", ["text"])
    met = signed.withColumn("after", F.coalesce(F.lead("own").over(order), F.first("own").over(order)))
    return met.where("_guest = 0").select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"),
        F.size("own").alias("n_signatures"),
    )
