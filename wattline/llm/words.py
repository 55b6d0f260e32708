"""Words of whole texts as hashes, in numpy.

A word is a maximal run of bytes other than space and 9 to 13. Its hash is a polynomial over random 64-bit values of its bytes,
finished by a mixing step; two different words or word sequences agree with a chance of about 2^-64.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240101)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the place of its first word (n + 1 borders)."""
    if not len(raw):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(borders), np.int64)
    gap = _GAP[raw]
    first = np.r_[True, gap[:-1]]
    last = np.r_[gap[1:], True]
    inner = borders[(borders > 0) & (borders < len(raw))]
    first[inner] = True
    last[inner - 1] = True
    starts = np.flatnonzero(first & ~gap)
    ends = np.flatnonzero(last & ~gap) + 1
    return starts, ends, np.searchsorted(starts, borders)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# Bytes that are hashed together, and so powers that a task keeps; only a longer word has more made for the occasion.
_KEPT = 1 << 19
_tables: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    known = _tables.get(int(base))
    if known is None or len(known) < n:
        steps = np.full(max(n, _KEPT), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps)
        if n <= _KEPT:
            _tables[int(base)] = known
    return known


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hash of the bytes of each span; with ``fold`` A-Z count as a-z. Spans ascend; they are hashed in blocks, so memory does not grow with a text."""
    out = np.empty(len(starts), np.uint64)
    begin = 0
    while begin < len(starts):
        end = max(begin + 1, int(np.searchsorted(ends, starts[begin] + _KEPT, "right")))
        first = int(starts[begin])
        part = raw[first : int(ends[end - 1])]
        total = np.empty(len(part) + 1, np.uint64)
        total[0] = 0
        np.cumsum((_FOLDED if fold else _BYTE)[part] * _powers(_BASE, len(part))[: len(part)], out=total[1:])
        # each span is moved to place 0, by the inverse of the power it starts with
        at = starts[begin:end] - first
        out[begin:end] = mix((total[ends[begin:end] - first] - total[at]) * _powers(_INVERSE, len(part))[at])
        begin = end
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on; the last n - 1 places are left out."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = words[:count].copy()
    for k in range(1, n):
        out = out * _BASE + words[k : k + count]
    return mix(out)
