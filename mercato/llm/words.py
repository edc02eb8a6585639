"""Exact numbers for words, lines and their combinations, a block of texts at a time.

Unlike the 64-bit hashes of ``common``, equal numbers here always mean equal
bytes: Arrow's dictionary encoding compares what it hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def encode(values: pa.Array) -> np.ndarray:
    """Numbers from 0 in order of first appearance; equal values share one."""
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def span_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One number for each of the ordered, disjoint byte spans [start, end); equal bytes, equal number."""
    if len(starts) == 0:
        return np.zeros(0, np.int64)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    off = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=off[1:])
    return encode(pa.Array.from_buffers(pa.large_binary(), len(starts),
                                        [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data[inside]))]))


def pair_ids(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair (a, b) of non-negative numbers."""
    if len(a) == 0:
        return np.zeros(0, np.int64)
    return encode(pa.array(a * (int(b.max()) + 1) + b))


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds ``first``."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
