"""The one large table that a Python worker keeps between its tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_kept: dict[str, Any] = {"key": None, "value": None}


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task, and others need the memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def kept_table(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` returned when ``key`` was last asked for, or returns now.

    Workers serve the tasks of many stages; a table of another key is given up
    first, so that a worker holds one at most.  The table is exempt from garbage
    collection, which would otherwise walk all of it after every task.
    """
    if _kept["key"] != key:
        _kept.update(key=None, value=None)
        gc.unfreeze()
        gc.collect()
        give_back()
        _kept.update(key=key, value=make())
    gc.freeze()
    return _kept["value"]
