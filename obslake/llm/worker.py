"""What a Python worker keeps between tasks."""

from __future__ import annotations

import ctypes
import sys
import types

import pyarrow as pa

_HOME = "obslake_worker_memory"


def memory(kind: str) -> dict:
    """A dictionary that lives as long as the Python worker.

    Task functions are shipped by value, so their own globals start anew with each task.
    """
    home = sys.modules.setdefault(_HOME, types.ModuleType(_HOME))
    return home.__dict__.setdefault(kind, {})


def give_back() -> None:
    """Return to the system what freed arrays and batches leave with the allocators.

    Workers outlive their tasks, so an executor would go on holding the most each has used.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)
