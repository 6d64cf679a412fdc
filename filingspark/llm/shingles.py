"""Word shingles of whole texts as 64-bit hashes, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
WINDOW = 1 << 18
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the public splitmix64 step)."""
    x = x + np.uint64(_BASE)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODES = mixed(np.arange(256, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, _INVERSE):
            factors = np.full(WINDOW + 1, base, dtype=np.uint64)
            factors[0] = 1
            _powers.append(np.multiply.accumulate(factors))
    return _powers


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each span: a difference of running sums, shifted to its start."""
    out = np.empty(len(starts), dtype=np.uint64)
    up, down = _power_tables()
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = int(np.searchsorted(ends, base + WINDOW, side="right"))
        if last <= first:  # one span longer than the window
            total, at = np.uint64(0), base
            while at < int(ends[first]):
                part = data[at : min(at + WINDOW, int(ends[first]))]
                total = mixed(np.array([total ^ np.sum(_CODES[part] * up[: len(part)])], dtype=np.uint64))[0]
                at += len(part)
            out[first] = total
            first += 1
            continue
        end = int(ends[last - 1])
        sums = np.zeros(end - base + 1, dtype=np.uint64)
        np.cumsum(_CODES[data[base:end]] * up[: end - base], out=sums[1:])
        a, b = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (sums[b] - sums[a]) * down[a]
        first = last
    return mixed(out)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and, per text, where its words begin.

    Words are the runs of bytes other than blanks 0x20 and 0x09-0x0D, A-Z in lower case.
    """
    base, end = int(offsets[0]), int(offsets[-1])
    data = _LOWER[data[base:end]]
    cuts = offsets - base
    word = ~_SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = cuts[:-1][cuts[:-1] < len(data)]
    begins[inner] = word[inner]
    stops = word.copy()
    stops[:-1] &= ~word[1:]
    last = cuts[1:][cuts[1:] > 0] - 1
    stops[last] = word[last]
    starts = np.flatnonzero(begins)
    return _span_hashes(data, starts, np.flatnonzero(stops) + 1), np.searchsorted(starts, cuts)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text; the whole sequence if it is shorter."""
    words, at = words_of(data, offsets)
    rolled = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    factor = 1
    for step in range(size):
        rolled += words[step : step + len(rolled)] * np.uint64(factor)
        factor = factor * _BASE & _MASK
    rolled = mixed(rolled)
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= size:
            yield np.unique(rolled[a : b - size + 1])
        elif b > a:
            total = 0
            for w in words[a:b]:
                total = (total * _BASE + int(w)) & _MASK
            yield mixed(np.array([total ^ int(b - a)], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)


def slices(texts: pa.Array, most: int = WINDOW) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, bytes, offsets)`` for runs of texts of about ``most`` bytes; NULL is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    _, at, body = texts.buffers()
    offsets = np.frombuffer(at, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, last, data, offsets[first : last + 1]
        first = last
