"""Memory of Python workers, which Spark keeps for later stages."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def given_back(work):
    """work, a generator over record batches, after which the worker returns to the system what it no longer needs."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # not glibc
                pass

    return run
