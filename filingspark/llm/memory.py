"""Memory that a worker holds after a task and the next stages on its machine could use."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def give_back() -> None:
    """Return what is free in this process to the system, where its allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run`` over the batches of a task, after which the worker keeps no memory that it does not use."""

    @wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole
