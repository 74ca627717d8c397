"""Memory of Python workers, which Spark keeps for the tasks of later stages."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """What this process has freed goes back to the system. Arrow and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def returning(run):
    """`run`, a function of a task's batches, whose worker gives memory back at the end of the task."""

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole
