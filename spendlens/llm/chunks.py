"""Arrow batches cut by bytes: a batch holds a number of rows, whatever their length,
so code that builds Python objects of a text takes it in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time.
SLICE_BYTES = 2 << 20


def by_bytes(batches: Iterable[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches (no copy) whose texts in ``column`` have about ``limit``
    bytes at most; a longer text makes a slice of its own.  Order and rows stay."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = done = 0
        while at < b.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield b.slice(at, stop - at)
            at, done = stop, int(ends[stop - 1])
