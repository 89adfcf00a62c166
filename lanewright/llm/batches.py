"""Bounded pieces of Arrow batches for the operators that run Python in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task turns into Python objects at a time; one longer text is taken alone.
PIECE = 4 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in ``column``, one row at least."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def octets(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def cuts(text: str, size: int = PIECE) -> Iterator[str]:
    """A long text in pieces that end after a space or a line end (whole if it has none)."""
    start = 0
    while len(text) - start > size:
        stop = max(text.rfind(" ", start, start + size), text.rfind("\n", start, start + size)) + 1
        if stop <= start:
            found = [p for p in (text.find(" ", start + size), text.find("\n", start + size)) if p >= 0]
            stop = min(found) + 1 if found else len(text)
        yield text[start:stop]
        start = stop
    yield text[start:]
