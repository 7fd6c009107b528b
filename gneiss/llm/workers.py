"""Memory of Python workers, which live on after their task."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import pyarrow as pa


def trim() -> None:
    """Give freed memory back, so that an idle worker does not hold what another stage needs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not every C library has it
        pass


def trimmed(run):
    """A mapInArrow function that trims its worker when its task ends."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped
