"""Texts inside Arrow batches: bounded blocks, flat byte arrays and result batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20


def blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about `limit` bytes in `column`; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary or string array without nulls, and its n + 1 offsets into them."""
    n, (_, ends, data) = len(values), values.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_binary(values.type) or pa.types.is_large_string(values.type) else np.int32
    offsets = np.frombuffer(ends, dtype=width)[values.offset:values.offset + n + 1].astype(np.int64)
    text = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return text[offsets[0]:offsets[-1]], offsets - offsets[0]


def padded(text: np.ndarray, offsets: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """The same bytes with `before` zero bytes ahead of each text, and where each text starts then."""
    n = len(offsets) - 1
    starts = offsets[:-1] + before * np.arange(1, n + 1)
    out = np.zeros(len(text) + before * n, np.uint8)
    out[np.arange(len(text)) + np.repeat(before * np.arange(1, n + 1), np.diff(offsets))] = text
    return out, starts
