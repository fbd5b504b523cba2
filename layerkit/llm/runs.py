"""Maximal runs of a byte class in many texts at once (numpy over Arrow buffers)."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import text_blocks

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32  # A-Z only


def stretches(batches: Iterator[pa.RecordBatch], column: str, inside: np.ndarray, most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of Arrow batches with about ``most`` bytes of text: (slice, bytes, offsets).
    A longer text comes as several slices of its one row, cut where bytes that
    ``inside`` (a flag for each byte value) does not hold separate its runs."""
    for part, body, offsets in text_blocks(batches, column, most):
        if len(body) <= most:
            yield part, body, offsets
            continue
        a, n = 0, len(body)
        while a < n:
            b = min(a + most, n)
            while b < n and inside[body[b]]:
                ahead = np.flatnonzero(~inside[body[b:b + most]])
                b = min(b + (int(ahead[0]) if len(ahead) else most), n)
            yield part, body[a:b], np.array([0, b - a], np.int64)
            a = b


def runs(body: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(the runs as binary values, with A-Z lower-cased if ``lower``, their first bytes, index
    of each text's first run with one more at the end). No run goes on into the next text."""
    flag = inside[body]
    n = len(flag)
    if n == 0:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edges = offsets[:-1][offsets[:-1] < n]
    first = flag.copy()
    first[1:] &= ~flag[:-1]
    first[edges] = flag[edges]
    last = flag.copy()
    last[:-1] &= ~flag[1:]
    inner = edges[edges > 0] - 1
    last[inner] = flag[inner]
    starts = np.flatnonzero(first)
    size = np.flatnonzero(last) + 1 - starts
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(size, out=bounds[1:])
    kept = _LOWER[body[flag]] if lower else body[flag]
    values = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(kept)])
    return values, starts, np.searchsorted(starts, offsets)
