"""Word shingle sets as sorted 64-bit hashes, computed for a whole Arrow batch at once."""

from __future__ import annotations

import numpy as np

from .common import mix64, odd_constants

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = odd_constants(256, 11)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_STEP = odd_constants(64, 23)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n + 1, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document index of every word: runs of bytes that are not ASCII white space,
    A-Z lower-cased; words never cross documents."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    black = ~_SPACE[buf]
    edge = np.zeros(n, dtype=bool)
    edge[off[:-1][off[:-1] < n]] = True
    before = np.concatenate(([False], black[:-1]))
    after = np.concatenate((black[1:], [False]))
    next_edge = np.concatenate((edge[1:], [True]))
    start = np.flatnonzero(black & (~before | edge))
    end = np.flatnonzero(black & (~after | next_edge)) + 1
    doc = np.searchsorted(off, start, side="right") - 1
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(
        _LETTER[_LOWER[buf]] * _powers(_BASE, n - 1), dtype=np.uint64)))
    h = (total[end] - total[start]) * _powers(_INVERSE, n)[start]
    return mix64(h + (end - start).astype(np.uint64) * _STEP[63]), doc


def shingle_sets(buf: np.ndarray, off: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each document's ``size``-word shingles. A document with fewer
    words gives its whole sequence as one shingle, one without words an empty set."""
    w, doc = words(buf, off)
    n_docs = len(off) - 1
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    m = max(0, len(w) - size + 1)
    s = np.zeros(m, dtype=np.uint64)
    for k in range(size):
        s += w[k:k + m] * _STEP[k]
    s = mix64(s)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            x = np.sort(s[a:b - size + 1])
            out.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
        elif b > a:
            x = (w[a:b] * _STEP[:b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix64(x + _STEP[40 + b - a]))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
