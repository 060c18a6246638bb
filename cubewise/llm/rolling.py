"""Rolling hashes over numpy arrays, shared by the operators that slide a
window over words, bytes or code points.

A window hash is a Rabin-Karp polynomial modulo 2**64, taken from prefix sums
of ``value[i] * BASE**-i`` (the base is odd, so it has an inverse), then mixed
so that all its bits can be compared or bucketed. Work runs in blocks, so the
tables of powers stay small however long a text is.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BLOCK = 1 << 15

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, 1 << 12, 2 * len(table) if table is not None else 0)
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        table = _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Mixed hash of every k consecutive uint64 values (empty if fewer)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        part = values[a:b + k - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers(BASE_INVERSE, len(part)), out=sums[1:])
        out[a:b] = (sums[k:] - sums[:-k]) * powers(BASE, b - a)
    return mix(out)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of the values in each [start, end); spans are disjoint and ascending."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + BLOCK, "right")))
        part = values[a:int(ends[j - 1])]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers(BASE_INVERSE, len(part)), out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * powers(BASE, len(part) + 1)[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def rightmost_minima(h: np.ndarray, w: int) -> np.ndarray:
    """For every w consecutive hashes the index of the smallest, the rightmost
    on ties (the upper 32 bits are compared)."""
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    out = np.empty(n, np.int64)
    low = np.uint64(0xFFFFFFFF)
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        m = h[a:b + w - 1] & ~low
        m |= low - np.arange(len(m), dtype=np.uint64)
        span = 1
        while 2 * span <= w:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        if span < w:
            rest = w - span
            m = np.minimum(m[:-rest], m[rest:])
        out[a:b] = (low - (m & low)).astype(np.int64) + a
    return out


def anchors(h: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Split the windows of w hashes into runs that choose the same minimum:
    (index of the minimum, first window, number of windows) of each run. Equal
    windows choose equal minima at equal places, whatever surrounds them."""
    at = rightmost_minima(h, w)
    if not len(at):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    return at[first], first, np.diff(np.append(first, len(at)))
