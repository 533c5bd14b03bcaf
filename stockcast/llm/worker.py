"""What a Python worker keeps between tasks: the state of one operator at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_held: dict[object, object] = {}


def give_back() -> None:
    """Return free memory of Arrow and the C library to the system, as a worker lives as long as its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library keeps it back
    if trim is not None:
        trim(0)


def keep(key: object, make: Callable[[], object]) -> object:
    """The state kept under ``key``, made on first use. Another operator's state is let go first."""
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Let all kept state go; for operators that keep none but need the memory."""
    if _held:
        _held.clear()
        gc.collect()
    give_back()
