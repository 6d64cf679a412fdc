"""Operator 2: language by unigram pieces, summed over all segmentations of a text."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingspark.llm.memory import tidy
from filingspark.llm.shingles import slices
from filingspark.llm.spans import LETTER, coded, kinds_of, listed

UNKNOWN = "und"
LONGEST_PIECE = 16
SHORT_WORD = 16
LONG_CELLS = 1 << 18
BLOCK = 4096
CACHED_WORDS = 200_000
MOST_LANGUAGES = 1024
PRIOR = 2000.0
WORTH = 8.0
UNIT = 1 << 16
TEXT_BYTES = 1 << 20


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Pieces:
    """The pieces of a public byte vocabulary up to ``LONGEST_PIECE`` bytes, found by hash.

    Every single byte is a piece, so each text has at least one segmentation. Before
    any text is seen, a piece's probability falls with its rank.
    """

    def __init__(self, path: str):
        ranked = [line.split() for line in open(path, "rb")]
        pieces = [(base64.b64decode(p), int(r)) for p, r in ranked]
        pieces = [(p, r) for p, r in pieces if len(p) <= LONGEST_PIECE]
        hashes = np.array([self._hash(p) for p, _ in pieces], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.count = len(pieces)
        weight = 1.0 / (np.array([r for _, r in pieces], dtype=np.float64)[order] + 100.0)
        self.start = weight / weight.sum()

    @staticmethod
    def _hash(piece: bytes) -> int:
        total = 0
        for byte in piece:
            total = (total + byte + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
            total ^= total >> 29
        return total

    def spans(self, words: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """Piece number of ``words[:, i:j]`` by ``(i, j)``, ``count`` where it is none."""
        found = {}
        for i in range(words.shape[1]):
            total = np.zeros(len(words), dtype=np.uint64)
            for j in range(i, min(words.shape[1], i + LONGEST_PIECE)):
                total = (total + words[:, j] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                total ^= total >> np.uint64(29)
                at = np.minimum(np.searchsorted(self.hashes, total), self.count - 1)
                known = self.hashes[at] == total
                if known.any():
                    found[i, j + 1] = np.where(known, at, self.count)
        return found

    def forward(self, words: np.ndarray, chances: np.ndarray, spans: dict) -> np.ndarray:
        """``[position, word, column]``: the sum over all segmentations up to each position.

        For words of at most ``SHORT_WORD`` bytes and a blank: these cannot leave the range
        of floats while a byte's chance is above 1e-18. ``scaled`` is for the others.
        """
        sums = np.zeros((words.shape[1] + 1, len(words), chances.shape[1]))
        sums[0] = 1.0
        for j in range(1, words.shape[1] + 1):
            for i in range(max(0, j - LONGEST_PIECE), j):
                if (i, j) in spans:
                    sums[j] += sums[i] * chances[spans[i, j]]
        return sums

    def expected(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Expected uses of pieces in each word, ``(piece numbers, uses)`` per span."""
        spans = self.spans(words)
        chances = np.append(self.start, 0.0)[:, None]
        ahead = self.forward(words, chances, spans)
        length = words.shape[1]
        behind = np.zeros((length + 1, len(words)))
        behind[length] = 1.0
        for i in range(length - 1, -1, -1):
            for j in range(i + 1, min(length, i + LONGEST_PIECE) + 1):
                if (i, j) in spans:
                    behind[i] += behind[j] * chances[spans[i, j], 0]
        total = ahead[length, :, 0]
        for (i, j), piece in spans.items():
            yield piece, ahead[i, :, 0] * chances[piece, 0] * behind[j] / total

    def ends(self, words: np.ndarray, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each position after ``first`` up to ``last``: starts of the pieces that end there, and
        ``[start, word]`` their numbers, ``count`` where it is none."""
        begun = max(0, first - LONGEST_PIECE + 1)
        totals = np.zeros((LONGEST_PIECE, len(words)), dtype=np.uint64)
        for j in range(begun + 1, last + 1):
            totals[(j - 1) % LONGEST_PIECE] = 0
            totals += words[:, j - 1].astype(np.uint64) + np.uint64(1)
            totals *= np.uint64(0x9E3779B97F4A7C15)
            totals ^= totals >> np.uint64(29)
            if j <= first:
                continue
            starts = np.arange(max(begun, j - LONGEST_PIECE), j)
            own = totals[starts % LONGEST_PIECE]
            at = np.minimum(np.searchsorted(self.hashes, own), self.count - 1)
            known = self.hashes[at] == own
            held = known.any(axis=1)
            yield starts[held], np.where(known, at, self.count)[held]

    def scaled(self, words: np.ndarray, chances: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``forward`` of long words, position by position from the first: ``(sums, log scale)``.

        The last sums are divided by the newest every ``LONGEST_PIECE`` positions, for each
        word and column, so they stay in the range of floats whatever the length.
        """
        window = np.zeros((LONGEST_PIECE, len(words), chances.shape[1]))
        window[0] = 1.0
        scale = np.zeros(window.shape[1:])
        for j, (starts, piece) in enumerate(self.ends(words, 0, words.shape[1]), 1):
            now = (window[starts % LONGEST_PIECE] * chances[piece]).sum(axis=0)
            window[j % LONGEST_PIECE] = now
            yield now, scale
            if j % LONGEST_PIECE == 0:
                window /= now
                scale = scale + np.log(now)

    def log_totals(self, words: np.ndarray, lengths: np.ndarray, chances: np.ndarray) -> np.ndarray:
        """``[word, column]``: log of the sum over all segmentations of long words, padded behind ``lengths``."""
        found = np.empty((len(words), chances.shape[1]))
        for j, (now, scale) in enumerate(self.scaled(words, chances), 1):
            if (done := lengths == j).any():
                found[done] = np.log(now[done]) + scale[done]
        return found

    def expected_long(self, words: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``expected`` of long words, padded behind ``lengths``."""
        chances = np.append(self.start, 0.0)
        size = words.shape[1]
        ahead = np.zeros((size + 1, len(words)))
        for j, (now, scale) in enumerate(self.scaled(words, chances[:, None]), 1):
            ahead[j] = np.log(now[:, 0]) + scale[:, 0]
        total = ahead[lengths, np.arange(len(words))]
        ring = LONGEST_PIECE + 1
        window = np.zeros((ring, len(words)))
        scale = np.zeros(len(words))
        for first in range((size - 1) // BLOCK * BLOCK, -1, -BLOCK):
            last = min(size, first + BLOCK)
            for j, (starts, piece) in zip(range(last, first, -1), [*self.ends(words, first, last)][::-1]):
                window[j % ring, lengths == j] = 1.0
                begun = j <= lengths
                if j % LONGEST_PIECE == 0:
                    by = np.where(begun, window[j % ring], 1.0)
                    window /= by
                    scale += np.log(by)
                now = window[j % ring].copy()
                window[j % ring] = 0.0
                window[starts % ring] += now * chances[piece]
                rest = np.log(now, out=np.full(len(words), -np.inf), where=begun) + scale - total
                yield from zip(piece, chances[piece] * np.exp(ahead[starts] + rest))


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and byte rows of the short words of each length, each with a blank before it."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(lengths[lengths <= SHORT_WORD]):
        at = np.flatnonzero(lengths == length)
        for part in np.array_split(at, len(at) // 20_000 + 1):
            rows = np.frombuffer(b"".join(words[i] for i in part), dtype=np.uint8).reshape(len(part), length)
            yield part, np.insert(rows, 0, 32, axis=1).astype(np.uint64)


def _long(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, padded byte rows and lengths of the other words, each with a blank before it.

    Words of one batch differ in length by less than a factor of two.
    """
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    at = np.flatnonzero(lengths > SHORT_WORD)
    at = at[np.argsort(lengths[at], kind="stable")]
    first = 0
    while first < len(at):
        least = lengths[at[first]]
        last = np.searchsorted(lengths[at], 2 * least)
        last = min(last, first + max(1, LONG_CELLS // (2 * least)))
        part = at[first:last]
        rows = np.zeros((len(part), lengths[part[-1]] + 1), dtype=np.uint8)
        rows[:, 0] = 32
        for row, i in zip(rows, part):
            row[1 : lengths[i] + 1] = np.frombuffer(words[i], dtype=np.uint8)
        yield part, rows, lengths[part] + 1
        first = last


def _runs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[bytes], np.ndarray]]:
    """``(first text, text of each run, code of each run, runs, is a word)``.

    Runs of letters in lower case are words, whatever their length.
    """
    lowered = pc.utf8_lower(texts.fill_null(""))
    for first, _, data, offsets in slices(lowered, TEXT_BYTES):
        data = data[offsets[0] : offsets[-1]]
        if not len(data):
            continue
        _, kinds, places = kinds_of(data)
        letter = kinds == LETTER
        fresh = np.ones(len(letter), dtype=bool)
        fresh[1:] = letter[1:] != letter[:-1]
        opens = offsets[:-1] - offsets[0]
        fresh[np.searchsorted(places, opens[opens < len(data)])] = True
        at = np.flatnonzero(fresh)
        starts = places[at]
        codes, found = coded(data, starts)
        owner = np.searchsorted(opens, starts, side="right") - 1
        is_word = np.zeros(len(found), dtype=bool)
        is_word[codes] = letter[at]
        yield first, owner, codes, listed(found), is_word


def _counts(langs: list[str], path: str):
    index = {lang: i for i, lang in enumerate(langs)}

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(path)
        uses = np.zeros((known.count + 1, len(langs)), dtype=np.int64)
        seen: dict[bytes, int] = {}
        counts = np.zeros((1024, len(langs)), dtype=np.int64)

        def settle() -> None:
            words = list(seen)
            short = ((part, known.expected(rows)) for part, rows in _by_length(words))
            long = ((part, known.expected_long(rows, lengths)) for part, rows, lengths in _long(words))
            for part, shares in chain(short, long):
                times = counts[part]
                for piece, share in shares:
                    np.add.at(uses, piece, np.rint(share * UNIT).astype(np.int64)[:, None] * times)
            seen.clear()
            counts[:] = 0

        for batch in batches:
            of = np.array([index[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for first, owner, codes, words, is_word in _runs(batch.column("text")):
                each = np.bincount(
                    codes * len(langs) + of[first + owner], minlength=len(words) * len(langs)
                ).reshape(-1, len(langs))
                at = [seen.setdefault(w, len(seen)) if k else -1 for w, k in zip(words, is_word)]
                while len(counts) < len(seen):
                    counts = np.concatenate([counts, np.zeros_like(counts)])
                at = np.array(at)
                counts[at[at >= 0]] += each[at >= 0]
                if len(seen) > CACHED_WORDS:
                    settle()
        settle()
        piece, lang = np.nonzero(uses[: known.count])
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(uses[piece, lang])],
            names=["lang", "piece", "uses"],
        )

    return run


def learn(labelled: DataFrame, path: str | None = None) -> tuple[list[str], np.ndarray]:
    """Languages and the chance of each piece in each, from all rows of ``lang, text``.

    Each word's segmentations are weighed by the starting chances; the expected uses
    are summed per language as whole numbers, so the model does not depend on how rows
    are dealt. The model has one number per piece and language, whatever the corpus.
    Rows with a NULL language are left out.
    """
    path = path or vocabulary_path()
    rows = labelled.where("lang is not null").select("lang", "text")
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    start = pieces(path).start
    if not langs:
        return [], np.zeros((len(start), 0))
    uses = np.zeros((len(start), len(langs)))
    per_task = rows.mapInArrow(_counts(langs, path), "lang int, piece int, uses long")
    # at most pieces x languages rows
    summed = per_task.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toArrow()
    uses[summed["piece"].to_numpy(), summed["lang"].to_numpy()] = summed["uses"].to_numpy() / UNIT
    return langs, (uses + PRIOR * start[:, None]) / (uses.sum(axis=0) + PRIOR)


def _judge(model: tuple[list[str], np.ndarray], path: str):
    """A function from arrays of texts to the language and score of each."""
    langs, chances = model
    padded = np.concatenate([chances, np.zeros((1, len(langs)))])
    names = np.array([*langs, UNKNOWN], dtype=object)

    def run(arrays: Iterator[pa.Array]) -> Iterator[tuple[pa.Array, pa.Array]]:
        known = pieces(path)
        seen: dict[bytes, int] = {}
        worth = np.zeros((1024, len(langs)))

        def scores(words: list[bytes]) -> np.ndarray:
            nonlocal worth
            if len(seen) + len(words) > CACHED_WORDS:
                seen.clear()
            fresh = [w for w in words if w not in seen]
            base = len(seen)
            seen.update(zip(fresh, range(base, base + len(fresh))))
            while len(worth) < len(seen):
                worth = np.concatenate([worth, np.zeros_like(worth)])
            for part, rows in _by_length(fresh):
                worth[base + part] = np.log(known.forward(rows, padded, known.spans(rows))[-1])
            for part, rows, lengths in _long(fresh):
                worth[base + part] = known.log_totals(rows, lengths, padded)
            return worth[[seen[w] for w in words]]

        for texts in arrays:
            total = np.zeros((len(texts), len(langs)))
            words_in = np.zeros(len(texts), dtype=np.int64)
            if langs:
                for first, owner, codes, words, is_word in _runs(texts):
                    table = np.zeros((len(words), len(langs)))
                    table[is_word] = scores([w for w, k in zip(words, is_word) if k])
                    rows = first + owner
                    words_in += np.bincount(rows[is_word[codes]], minlength=len(texts))
                    for i in range(len(langs)):
                        total[:, i] += np.bincount(rows, weights=table[codes, i], minlength=len(texts))
            empty = words_in == 0
            best = np.where(empty, len(langs), total.argmax(axis=1) if langs else 0)
            cooled = (total - total.max(axis=1, keepdims=True, initial=-np.inf)) if langs else total
            cooled = cooled / np.maximum(1.0, words_in / WORTH)[:, None]
            score = np.where(empty, 0.0, 1.0 / np.maximum(1.0, np.exp(cooled).sum(axis=1)))
            yield pa.array(names[best], pa.string()), pa.array(score)

    return run


def identify(
    docs: DataFrame, model: tuple[list[str], np.ndarray], path: str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` (by default all), ``lang_pred`` and ``score`` of rows with ``text``.

    A text is worth the product over its words (runs of letters in lower case) of the
    sum over all their segmentations into pieces. ``lang_pred`` is the language in
    which that is greatest, the first by name among equals; ``und`` if the text is
    NULL or has no letter, or if no language was learnt. ``score`` is the posterior of
    that language with the evidence tempered to ``WORTH`` words, 0 for ``und``.
    Columns of these names are replaced. Only texts reach the Python workers.
    """
    judge = _judge(model, path or vocabulary_path())
    kept = [c for c in columns or docs.columns if c not in ("lang_pred", "score")]

    def judged(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        @tidy
        def run(arrays):
            for pred, score in judge(arrays):
                yield pa.StructArray.from_arrays([pred, score], names=["lang_pred", "score"])

        yield from run(texts)

    found = F.arrow_udf(judged, "lang_pred string, score double").asNondeterministic()  # so that it runs once a row
    name = "_judged"
    while name in docs.columns:
        name += "_"
    rows = docs.select(*[F.col(c) for c in kept], found(F.col("text")).alias(name))
    return rows.select(*kept, f"{name}.lang_pred", f"{name}.score")


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether the CRC-32 of the id's digits leaves ``fold``; never for NULL."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def accuracy(predicted: DataFrame) -> pd.DataFrame:
    """Accuracy by ``held_out`` for rows with ``lang, lang_pred, held_out``."""
    right = F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))
    return predicted.groupBy("held_out").agg(right.alias("accuracy"), F.count("*").alias("n")).toPandas()
