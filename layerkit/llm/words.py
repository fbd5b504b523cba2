"""Words of many texts at once, as 64-bit hashes (numpy over Arrow buffers)."""
from __future__ import annotations

import numpy as np

from .common import SPACES, byte_hashes, mix64

_BYTES = byte_hashes(7)
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32  # A-Z only
#: Hash value of each byte, 0 for what separates words; upper and lower case alike, or not.
_VALUES = {lower: np.where(_SPACE, np.uint64(0), _BYTES[_LOWER] if lower else _BYTES) for lower in (True, False)}
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER = _powers(64)


def words(body: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, number of bytes) of every word, and the index of each text's
    first word (one more at the end). Texts lie at ``offsets`` of ``body``."""
    global _POWER
    n = len(body)
    if n == 0:
        zero = np.zeros(0, np.int64)
        return zero.astype(np.uint64), zero, zero, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[body]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    first[edges] = inside[edges]  # a word never runs on into the next text
    starts = np.flatnonzero(first)
    heads = np.searchsorted(starts, offsets)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), starts, starts, heads
    run = np.diff(np.append(starts, n))
    place = np.arange(starts[0], n, dtype=np.int32) - np.repeat(starts.astype(np.int32), run)
    if int(run.max()) > len(_POWER):
        _POWER = _powers(int(run.max()))
    last = inside
    last[:-1] &= ~inside[1:]
    last[edges[edges > 0] - 1] |= ~_SPACE[body[edges[edges > 0] - 1]]
    size = np.flatnonzero(last) + 1 - starts
    value = _VALUES[lower][body[starts[0]:]]
    value *= _POWER[place]
    return mix64(np.add.reduceat(value, starts - starts[0]) + size.astype(np.uint64)), starts, size, heads


def shingle_sets(body: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's runs of ``width`` words; a text with
    fewer words has one for the whole sequence, one without words none."""
    hashed, _, _, heads = words(body, offsets)
    mul = np.uint64(0xD1342543DE82EF95)
    rolled = np.zeros(max(len(hashed) - width + 1, 0), np.uint64)
    for k in range(width):
        rolled = rolled * mul + hashed[k:k + len(rolled)]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(heads[:-1], heads[1:]):
        if b - a >= width:
            some = np.sort(rolled[a:b - width + 1])
            fresh = np.empty(len(some), bool)
            fresh[0] = True
            np.not_equal(some[1:], some[:-1], out=fresh[1:])
            out.append(some[fresh])
        elif b > a:
            whole = np.uint64(b - a)
            for h in hashed[a:b]:
                whole = np.uint64((int(whole) * int(mul) + int(h)) % (1 << 64))
            out.append(mix64(np.array([whole])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
