"""Arrow batches in pieces, so that a Python worker holds few texts as objects at once."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc


def pieces(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose strings in a column have `most` bytes together, or one row."""
    at = total = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if i > at and total + n > most:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    if at < batch.num_rows:
        yield batch.slice(at)


def give_back() -> None:
    """Return memory that this worker has freed to the system; idle workers share the executor's limit."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass
