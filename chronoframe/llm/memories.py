"""What a Python worker keeps from task to task: the memory of one operator at a time.

Spark uses its Python workers again, also for the next operator. Tables worth
keeping between tasks (an encoder with the pieces it has met) are held here;
an operator that starts in the same worker lets those of others go, and gives
the memory back that they left: an allocator keeps what was freed, so a worker
would else stay as large as the largest operator before, on top of its own needs.
"""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa

_held: dict = {}


def trim() -> None:
    """Hand freed memory to the system (Arrow's pool; the C heap where the C library can)."""
    pa.default_memory_pool().release_unused()
    malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if malloc_trim:
        malloc_trim(0)


def give_back() -> None:
    """:func:`trim` after what only cycles hold has been freed too."""
    gc.collect()
    trim()


def held(key, make):
    """The value kept under ``key``, made if this worker does not have it; values under other keys are dropped."""
    if key not in _held:
        release()
        _held[key] = make()
    return _held[key]


def release() -> None:
    """Drop what other operators have left in this worker."""
    _held.clear()
    give_back()
