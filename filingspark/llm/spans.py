"""Texts cut into runs of characters, as dictionary-coded Arrow arrays."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_UNSEEN = 255
_kinds = np.full(0x110000, _UNSEEN, dtype=np.uint8)
# The control characters that count as white space.
_CONTROL_SPACES = {*range(9, 14), 0x85}


def _kind(point: int) -> int:
    category = unicodedata.category(chr(point))
    if category[0] in "LN":
        return LETTER if category[0] == "L" else NUMBER
    return SPACE if category[0] == "Z" or point in _CONTROL_SPACES else OTHER


def kinds_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(code points, kinds, byte offsets)`` of the characters of UTF-8 bytes."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    kinds = _kinds[points]
    if (unseen := kinds == _UNSEEN).any():
        for point in np.unique(points[unseen]).tolist():
            _kinds[point] = _kind(point)
        kinds = _kinds[points]
    return points, kinds, np.flatnonzero((data & 0xC0) != 0x80)


def coded(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Number of each span and the distinct spans; spans begin at ``starts`` and leave no gaps."""
    offsets = np.append(starts, len(data)).astype(np.int32)
    spans = pa.BinaryArray.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )
    found = spans.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def listed(spans: pa.Array) -> list[bytes]:
    """The members of a binary array, cut from its buffer."""
    _, at, body = spans.buffers()
    offsets = np.frombuffer(at, dtype=np.int32)[spans.offset : spans.offset + len(spans) + 1].tolist()
    raw = body.to_pybytes() if body is not None else b""
    return [raw[a:b] for a, b in zip(offsets, offsets[1:])]
