"""Arrow arrays of strings and lists as flat numpy arrays, and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on together.
STEP_BYTES = 1 << 24


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings and where each begins among them, and the end."""
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    all_bytes = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return all_bytes[off[0] : off[-1]], off - off[0]


def step_ranges(texts: pa.Array, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text."""
    off = bytes_of(texts)[1]
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(off, off[begin] + size)))
        yield begin, min(end, len(texts))
        begin = end


def as_lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    """Consecutive runs of ``values`` of these sizes."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def list_sizes(lists: pa.ListArray) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy()).astype(np.int64)


def run_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` of these sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]
