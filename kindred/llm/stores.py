"""Large objects of a worker process, such as a tokenizer with the words it has met.

Workers are reused by later tasks of any operator, so an object that an operator keeps for
its next task would stay while others run. A process holds one at most: asking for another
one, or starting a task that uses none, lets go of it.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa

_held: dict[tuple, Any] = {}


def resident(build: Callable[..., Any], *arguments: Any) -> Any:
    """``build(*arguments)``, kept in this process until another object is asked for."""
    key = build, *arguments
    if key not in _held:
        release()
        _held[key] = build(*arguments)
    return _held[key]


def release() -> None:
    """Let go of the object held."""
    if _held:
        _held.clear()
        gc.collect()
        trim()


def trim() -> None:
    """Give memory that was freed back to the system; a pool keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    freed = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if freed is not None:
        freed(0)
