"""Documents: visible text, headers, chunks, full-text search, entity mentions."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingspark.functions import clean, vectors
from filingspark.functions.folds import fold_emitting, let
from filingspark.operators.keys import spread_join

ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
NAMED = {name: text for name, text in html5.items() if name.endswith(";")}  # the standard's list
INVISIBLE = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
FIRST_BOLD = r"(?is)<b(?:\s[^>]*)?>(.*)$"
_CUT = "\u0001"
_WORD = re.compile(r"[^\W_]+")
CHUNK_SIZE = 768
SPANS_PER_BATCH = 50_000
MOST_NAMES = 200_000
SEPARATORS = ("\n\n", "\n", " ", "")


def _numbered(code: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    # 128 to 159 are read in the code page that browsers use for them
    windows = [bytes([n]).decode("cp1252", "replace") for n in range(128, 160)]
    page = F.get(F.array(*[F.lit(c) for c in windows]), (code - 128).cast("int"))
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    return (
        F.when(code.between(128, 159), page)
        .when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        .otherwise("\ufffd")
    )


def entities_decoded(text: Column) -> Column:
    """``text`` with its numeric and named character entities decoded, each once."""

    def piece(part: Column) -> Column:
        hexadecimal = F.conv(F.regexp_extract(part, r"^&#[xX]([0-9a-fA-F]+);$", 1), 16, 10)
        decimal = F.regexp_extract(part, r"^&#([0-9]+);$", 1)
        name = F.substring(part, F.lit(2), F.length(part))
        named = F.map_from_arrays(F.array(*map(F.lit, NAMED)), F.array(*map(F.lit, NAMED.values())))
        return (
            F.when(~part.startswith("&") | (F.length(part) < 3), part)
            .when(decimal != "", _numbered(decimal.try_cast("bigint")))
            .when(part.rlike("^&#[xX]"), _numbered(hexadecimal.try_cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(named, name), part))
        )

    parts = F.regexp_extract_all(text, F.lit(ENTITY + "|[^&]+|&"), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(parts, piece), "")).otherwise(text)


def html_strings(html: Column) -> Column:
    """Text nodes after the first bold tag, blank ones dropped; no bold tag, no strings."""
    body = F.regexp_extract(F.regexp_replace(html, INVISIBLE, "<>"), FIRST_BOLD, 1)
    nodes = F.split(F.regexp_replace(body, "<[^>]*>", _CUT), _CUT)

    def decode(node: Column) -> Column:
        return clean.plain_spaces(entities_decoded(node))

    return F.filter(F.transform(nodes, decode), lambda s: s.rlike(r"\S"))


def html_text(pages: DataFrame, key: str, html: str) -> DataFrame:
    return pages.select(key, F.posexplode(html_strings(F.col(html))).alias("pos", "text"))


HEADER_ROW = "struct<path:string,level:int,key:string,value:string>"
_LEVELS = "array<struct<level:int,key:string>>"


def _header_lines(block: Column) -> Column:
    """``level, name, value`` of the lines with a colon; leading tabs give the level."""

    def line(text: Column) -> Column:
        level = F.length(F.regexp_extract(text, r"^\t*", 0))
        return let(
            F.struct(level.alias("level"), F.split(F.substring(text, level + 1, F.length(text)), "\t").alias("cells")),
            lambda l: F.struct(
                l["level"].alias("level"),
                F.trim(F.replace(F.get(l["cells"], F.lit(0)), F.lit(":"), F.lit(""))).alias("name"),
                F.when(F.size(l["cells"]) > 1, F.element_at(l["cells"], -1)).otherwise("").alias("value"),
            ),
        )

    return F.transform(F.filter(F.split(block, r"\r?\n"), lambda text: text.contains(":")), line)


def _header_step(state: Column, line: Column) -> tuple[Column, Column]:
    """One line: the open levels above it, the former companies so far, and its row."""
    above = F.filter(state["above"], lambda a: a["level"] < line["level"])
    parent = F.array_join(F.transform(above, lambda a: a["key"]), "/")
    tag = F.concat(parent, F.lit("\n"), line["name"])
    former = line["name"].contains("FORMER COMPANY")
    earlier = F.size(F.filter(state["seen"], lambda s: s == tag))
    key = F.when(former & (earlier > 0), F.concat(line["name"], (earlier + 1).cast("string"))).otherwise(line["name"])
    opened = F.array(F.struct(line["level"].alias("level"), key.alias("key")))
    row = F.struct(
        F.when(parent != "", F.concat(parent, F.lit("/"), key)).otherwise(key).alias("path"),
        line["level"].alias("level"), key.alias("key"), line["value"].alias("value"),
    )
    seen = F.when(former, F.concat(state["seen"], F.array(tag))).otherwise(state["seen"])
    return F.struct(F.concat(above, opened).alias("above"), seen.alias("seen")), F.array(row)


def header_tree(text: Column) -> Column:
    """``KEY:<tabs>value`` lines as ``array<struct<path, level, key, value>>``.

    Leading tabs give the level, and a line belongs to the nearest line above
    with a smaller one. A repeated FORMER COMPANY below the same parent is
    numbered from 2. The tagged header block is read where there is one, else
    the whole text if it has a key on a line indented by tabs; other texts have no
    rows. A fold over the lines carries the levels that are open.
    """
    block = F.regexp_extract(text, r"(?is)<SEC-HEADER>(.*?)</SEC-HEADER>", 1)
    bare = F.when(text.rlike(r"(?m)^\t+[^\t\n:]+:"), text)
    start = F.struct(F.array().cast(_LEVELS).alias("above"), F.array().cast("array<string>").alias("seen"))
    lines = _header_lines(F.coalesce(F.when(block != "", block), bare, F.lit("")))
    return let(lines, lambda found: fold_emitting(found, start, _header_step, HEADER_ROW)["out"])


def sgml_header(df: DataFrame, key: str, text: str) -> DataFrame:
    rows = F.posexplode_outer(header_tree(F.col(text))).alias("pos", "_r")
    return df.select(key, rows).where("pos is not null").select(key, "pos", "_r.*")


def clean_filings(raw: DataFrame, content: str = "rawContent") -> DataFrame:
    """Raw filing files with their header rows as ``cleanContent``; files without any drop out."""
    tree = raw.withColumn("cleanContent", header_tree(F.col(content).cast("string")))
    return tree.where(F.size("cleanContent") > 0)


def chunk_fixed(df: DataFrame, key: str, text: str, size: int = CHUNK_SIZE) -> DataFrame:
    """Consecutive pieces of ``size`` characters, the last one shorter."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return df.select(key, F.posexplode(pieces).alias("chunk", "content"))


def split_text(text: str, size: int, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Pieces of at most ``size`` characters, cut at the coarsest separator that fits."""
    if len(text) <= size:
        return [text.strip()] if text.strip() else []
    at = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    separator, finer = separators[at], separators[at + 1 :]
    if not separator:
        return [p for p in (text[i : i + size].strip() for i in range(0, len(text), size)) if p]
    head, *tail = text.split(separator)
    out: list[str] = []
    held: list[str] = []
    length = 0
    for part in [head, *(separator + t for t in tail)]:
        if held and length + len(part) > size:
            out += split_text("".join(held), size, finer)
            held, length = [], 0
        held.append(part)
        length += len(part)
    return out + split_text("".join(held), size, finer)


def chunk_recursive(
    df: DataFrame, key: str, text: str, uri: str, size: int = CHUNK_SIZE
) -> DataFrame:
    """Chunks that prefer paragraph, line and word ends; each keeps its source uri."""
    schema = f"{key} {dict(df.dtypes)[key]}, {uri} string, chunk int, content string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (k, u, i, piece)
                for k, u, t in zip(batch[key], batch[uri], batch[text])
                for i, piece in enumerate(split_text(t or "", size))
            ]
            yield pd.DataFrame(rows, columns=[key, uri, "chunk", "content"])

    return df.select(key, uri, text).mapInPandas(run, schema)


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def query_terms(query: str) -> list[str]:
    return list(dict.fromkeys(_WORD.findall(query.lower())))


def _edits(term: str, fuzziness: str) -> int:
    if fuzziness != "AUTO":
        return int(fuzziness)
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def text_match(
    df: DataFrame,
    fields: Sequence[str],
    query: str,
    operator: str = "or",
    fuzziness: str = "0",
    zero_terms: str = "none",
) -> DataFrame:
    """Rows in which a field holds any (``or``) or all (``and``) words of ``query``.

    Adds ``matched``, the best number of words found in one field. A word also
    matches within ``fuzziness`` edits (0 to 5, or AUTO by word length). Each row
    is decided on its own, without shuffling words.
    """
    if operator.lower() not in ("and", "or"):
        raise ValueError(f"unknown operator {operator}")
    terms = query_terms(query)
    if not terms:
        return df.withColumn("matched", F.lit(0)).where(F.lit(zero_terms == "all"))

    def found(words: Column, term: str) -> Column:
        edits = _edits(term, fuzziness)
        if edits == 0:
            return F.array_contains(words, term)
        return F.exists(words, lambda w: F.levenshtein(w, F.lit(term), edits) >= 0)

    def hits(words: Column) -> Column:
        return reduce(lambda a, b: a + b, [found(words, t).cast("int") for t in terms])

    per_field = F.transform(F.array(*[tokens(F.col(f)) for f in fields]), hits)
    needed = len(terms) if operator.lower() == "and" else 1
    return df.withColumn("matched", F.array_max(per_field)).where(F.col("matched") >= needed)


def search(df: DataFrame, query: Mapping[str, Mapping]) -> DataFrame:
    """A one-entry query: match, match_all, match_none, term or simple_query_string."""
    ((kind, body),) = query.items()
    if kind == "match_all":
        return df
    if kind == "match_none":
        return df.where(F.lit(False))
    if kind == "simple_query_string":
        return text_match(df, body["fields"], body["query"], body.get("default_operator") or "or")
    ((field, wanted),) = body.items()
    if kind == "term":
        return term_match(df, field, wanted)
    if kind == "match":
        options = {"query": wanted} if isinstance(wanted, str) else dict(wanted)
        zero_terms = options.pop("zero_terms_query", "none")
        return text_match(df, [field], zero_terms=zero_terms, **options)
    raise ValueError(f"unknown query {kind}")


def term_match(df: DataFrame, field: str, value) -> DataFrame:
    return df.where(F.col(field) == F.lit(value))


def _equals(term: str):
    return lambda word: word == term


def bm25(df: DataFrame, key: str, text: str, query: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``(key, score)`` of the rows holding a query word.

    Word counts are taken inside each row; only the collection figures (rows,
    mean length, rows per word) are aggregated, into one row. A query without words
    finds nothing.
    """
    terms = query_terms(query)
    if not terms:
        return df.select(key, F.lit(0.0).alias("score")).where(F.lit(False))

    def found(words: Column) -> Column:
        return F.struct(F.size(words).alias("len"), F.filter(words, lambda w: w.isin(*terms)).alias("hits"))

    def tally(doc: Column) -> Column:
        per_term = [F.size(F.filter(doc["hits"], _equals(t))) for t in terms]
        return F.array(doc["len"], *per_term)

    listed = F.transform(F.transform(F.array(tokens(F.col(text))), found), tally)
    counts = df.select(key, F.get(listed, F.lit(0)).alias("_c"))
    length, tfs = F.get("_c", F.lit(0)), [F.get("_c", F.lit(i + 1)) for i in range(len(terms))]
    stats = counts.agg(
        F.struct(
            F.count("*").alias("n"),
            F.avg(length).alias("len"),
            *[F.count_if(tf > 0).alias(f"df{i}") for i, tf in enumerate(tfs)],
        )
    ).scalar()

    def part(i: int) -> Column:
        tf, rows = tfs[i], stats[f"df{i}"]
        idf = F.ln(1 + (stats["n"] - rows + 0.5) / (rows + 0.5))
        return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / stats["len"]))

    some = counts.where(F.array_max(F.slice("_c", 2, len(terms))) > 0)
    return some.select(key, reduce(lambda x, y: x + y, map(part, range(len(terms)))).alias("score"))


def spans(df: DataFrame, key: str, text: str, max_words: int = 1) -> DataFrame:
    """Runs of one to ``max_words`` words with character offsets, end exclusive."""
    schema = f"{key} {dict(df.dtypes)[key]}, start int, end int, text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, starts, ends, found = [], [], [], []
        for batch in batches:
            for k, body in zip(batch[key], batch[text]):
                bounds = [m.span() for m in _WORD.finditer(body or "")]
                for words in range(1, max_words + 1):
                    first = [b[0] for b in bounds[: len(bounds) - words + 1]]
                    last = [b[1] for b in bounds[words - 1 :]]
                    starts += first
                    ends += last
                    found += [body[i:j] for i, j in zip(first, last)]
                    keys += [k] * len(first)
                if len(found) >= SPANS_PER_BATCH:
                    yield pd.DataFrame({key: keys, "start": starts, "end": ends, "text": found})
                    keys, starts, ends, found = [], [], [], []
        if found:
            yield pd.DataFrame({key: keys, "start": starts, "end": ends, "text": found})

    return df.select(key, text).mapInPandas(run, schema)


def _found_in_rows(df: DataFrame, key: str, text: str, labels: Mapping[str, str], max_words: int) -> DataFrame:
    """The hits of ``spans`` among ``labels``, looked up while the words are in their row."""
    schema = f"{key} {dict(df.dtypes)[key]}, start int, end int, text string, label string"
    first = {name.split(" ", 1)[0] for name in labels}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, body in zip(batch[key], batch[text]):
                body = body or ""
                bounds = [m.span() for m in _WORD.finditer(body)]
                for i, (start, stop) in enumerate(bounds):
                    if body[start:stop].lower() not in first:
                        continue
                    for _, end in bounds[i : i + max_words]:
                        label = labels.get(body[start:end].lower())
                        if label is not None:
                            rows.append((k, start, end, body[start:end], label))
            yield pd.DataFrame(rows, columns=[key, "start", "end", "text", "label"])

    return df.select(key, text).mapInPandas(run, schema)


def mentions(
    df: DataFrame, key: str, text: str, gazetteer: DataFrame, max_words: int = 1, most_names: int = MOST_NAMES
) -> DataFrame:
    """Occurrences of gazetteer names ``(name, label)``, case-insensitive, each with an id.

    Up to ``most_names`` names go along with the tasks, which read each text once and
    emit hits only. A longer list is joined instead: words are counted ahead (without
    making spans), and spans that begin with a very common word are spread over tasks.
    """
    names = gazetteer.select(F.lower("name").alias("_name"), "label").where("_name is not null").groupBy("_name").agg(
        F.min("label").alias("label")
    )
    digest = F.sha2(F.concat_ws("|", F.col(key).cast("string"), "start", "end"), 256)
    few = names.limit(most_names + 1).collect()  # the check of the size
    if len(few) <= most_names:
        hits = _found_in_rows(df, key, text, {r["_name"]: r["label"] for r in few}, max_words)
        return hits.select(key, digest.alias("mention_id"), "text", "label", "start", "end")
    found = spans(df, key, text, max_words).withColumn("_name", F.lower("text"))
    first = F.split_part("_name", F.lit(" "), F.lit(1)).alias("_first")
    words = df.select(F.explode(tokens(F.col(text))).alias("_first"))
    hits = spread_join(
        found.select("*", first),
        names.select("*", first),
        ["_first", "_name"],
        spread_on=[key, "start"],
        counts=words.groupBy("_first").agg(F.count("*").alias("_n")),
    )
    return hits.select(key, digest.alias("mention_id"), "text", "label", "start", "end")


def entity_pairs(found: DataFrame, df: DataFrame, key: str, text: str) -> DataFrame:
    """Each mention with the next one of its text and the snippet between them.

    A text's mentions are gathered, as many as it has, so the text itself is joined once.
    """
    listed = F.sort_array(F.collect_list(F.struct("start", "end", "mention_id")))
    per_text = found.groupBy(key).agg(listed.alias("_m")).where(F.size("_m") > 1)
    body = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def pair(head: Column, at: Column) -> Column:
        tail = F.get("_m", at + 1)
        length = F.greatest(tail["start"] - 2 - head["end"], F.lit(0))
        snippet = F.substring(F.col("_text"), head["end"] + 2, length)
        return F.struct(head["mention_id"].alias("head_id"), tail["mention_id"].alias("tail_id"), snippet.alias("snippet"))

    heads = F.slice("_m", F.lit(1), F.size("_m") - 1)
    joined = per_text.join(body, F.col(key) == F.col("_key"))
    return joined.select(key, F.inline(F.transform(heads, pair)))


def relation_labels(
    snippets: DataFrame, vector: str, labels: Mapping[str, Sequence[float]], threshold: float = 0.5
) -> DataFrame:
    """Adds the most similar label and its cosine; rows below ``threshold`` are dropped."""
    found = vectors.score_all(F.col(vector), list(labels.values()))
    named = F.arrays_zip(found.alias("score"), F.array(*[F.lit(n) for n in labels]).alias("label"))
    best = snippets.withColumn("_best", F.array_max(named))
    return (
        best.where(F.col("_best.score") >= threshold)
        .withColumns({"label": F.col("_best.label"), "score": F.col("_best.score")})
        .drop("_best")
    )


def rag_context(hits: DataFrame, query: str, rank: str, text: str, separator: str = "\n\n") -> DataFrame:
    """One context per query from its (at most k) ranked hits, best first."""
    ordered = F.array_sort(F.collect_list(F.struct(rank, text)))
    return hits.groupBy(query).agg(
        F.array_join(F.transform(ordered, lambda h: h[text]), separator).alias("context")
    )


def chat_history(turns: DataFrame, block: int = 32) -> DataFrame:
    """Conversations as ordered text blocks ``(conv_id, block, history)``.

    A block holds the lines of ``block`` consecutive turn numbers, so one very
    long conversation is many bounded rows; its blocks in order are its history.
    """
    line = F.concat_ws(": ", "role", "text").alias("line")
    at = F.floor(F.col("turn") / block).cast("bigint")
    ordered = F.array_sort(F.collect_list(F.struct("turn", line)))
    return turns.groupBy("conv_id", at.alias("block")).agg(
        F.array_join(F.transform(ordered, lambda t: t["line"]), "\n").alias("history")
    )
