"""Arrow string columns as numpy bytes, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and its n + 1 offsets; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.large_binary():
        column = pc.fill_null(column, "").cast(pa.large_string())
    size = len(column)
    if size == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, size + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(offsets: np.ndarray, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``block_bytes`` each; a longer row is a block of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last
