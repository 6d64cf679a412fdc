"""Running CRC-32 of bytes, and the CRC of any span of them from two running values."""

from __future__ import annotations

from functools import cache

import numpy as np

# Fixed value: the reflected polynomial of the common CRC-32.
POLYNOMIAL = 0xEDB88320
LANE = 256
_FULL = np.uint32(0xFFFFFFFF)


@cache
def _bytes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _stepped(state: np.ndarray, byte) -> np.ndarray:
    return _bytes()[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def _applied(tables: np.ndarray, row: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The linear map number ``row`` of each value: one lookup for each of its four bytes."""
    base = row.astype(np.int64) << 10
    out = tables[base + (crc & np.uint32(255))]
    for part in (1, 2, 3):
        out = out ^ tables[base + (part << 8) + ((crc >> np.uint32(8 * part)) & np.uint32(255))]
    return out


@cache
def _shifts(level: int) -> np.ndarray:
    """Maps that append 0 to 255 times ``256 ** level`` zero bytes, as 256 x 4 x 256 values in a row."""
    values = np.arange(256, dtype=np.uint32)
    rows = [np.concatenate([values << np.uint32(8 * part) for part in range(4)])]
    for _ in range(255):
        last = rows[-1]
        if level == 0:
            rows.append(_stepped(last, np.uint32(0)))
        else:
            rows.append(_whole(level - 1, last))
    return np.concatenate(rows)


def _whole(level: int, crc: np.ndarray) -> np.ndarray:
    """``256 ** (level + 1)`` zero bytes appended: 255 steps of this level and one more."""
    tables = _shifts(level)
    for row in (255, 1):
        crc = _applied(tables, np.full(len(crc), row), crc)
    return crc


def shifted(crc: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Each value multiplied by ``x ** (8 * count)`` over GF(2): what it adds to a text ``count`` bytes on."""
    out = _applied(_shifts(0), count & 255, crc)
    level, rest = 1, count >> 8
    while rest.any():
        some = np.flatnonzero(rest & 255)
        if len(some):
            out[some] = _applied(_shifts(level), rest[some] & 255, out[some])
        level, rest = level + 1, rest >> 8
    return out


class Running:
    """CRCs of all prefixes of ``data``, found in one scan of lanes side by side."""

    def __init__(self, data: np.ndarray):
        lanes = -(-len(data) // LANE)
        padded = np.zeros(lanes * LANE, dtype=np.uint8)
        padded[: len(data)] = data
        columns = np.ascontiguousarray(padded.reshape(lanes, LANE).T)
        own = np.zeros((LANE + 1, lanes), dtype=np.uint32)
        state = np.full(lanes, _FULL)
        for at in range(LANE):
            state = _stepped(state, columns[at])
            own[at + 1] = state ^ _FULL
        self.own = own
        whole, reach = own[LANE].copy(), 1
        while reach < lanes:  # CRCs of ever longer runs of lanes
            whole[reach:] ^= shifted(whole[:-reach], np.full(lanes - reach, reach * LANE))
            reach *= 2
        self.before = np.append(np.uint32(0), whole)

    def at(self, ends: np.ndarray) -> np.ndarray:
        """CRC of the first ``ends`` bytes."""
        lane, inner = ends // LANE, ends % LANE
        own = np.where(inner > 0, self.own[inner, np.minimum(lane, self.own.shape[1] - 1)], np.uint32(0))
        return shifted(self.before[lane], inner) ^ own


def followed(crc: np.ndarray, byte: int) -> np.ndarray:
    """CRCs of the same texts with one more byte."""
    return _stepped(crc ^ _FULL, np.uint32(byte)) ^ _FULL


def span(before: np.ndarray, after: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of the last ``length`` bytes of a text, from its CRCs without and with them."""
    return after ^ shifted(before, length)
