"""A compressed FM-index over words: packed wavelet matrix, backward search, matching statistics. In numpy, for one shard."""

from __future__ import annotations

import numpy as np


class BitRank:
    """Packed bits with counts per 64-bit word."""

    def __init__(self, bits: np.ndarray):
        size = len(bits)
        packed = np.packbits(np.concatenate([bits, np.zeros(-size % 64 + 64, bool)]), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int32)[:-1]].astype(np.int32)
        self.zeros = size - int(bits.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Number of set bits before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank of any symbol in a sequence, one packed level per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for k in range(bits - 1, -1, -1):
            level = (symbols >> k & 1).astype(bool)
            self.levels.append((k, BitRank(level)))
            symbols = np.concatenate([symbols[~level], symbols[level]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``at``, element by element."""
        low, high = np.zeros_like(at), at
        for k, bits in self.levels:
            one = (symbol >> k & 1).astype(bool)
            a, b = bits.ones(low), bits.ones(high)
            low, high = np.where(one, bits.zeros + a, low - a), np.where(one, bits.zeros + b, high - b)
        return high - low


def _renumber(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    fresh = np.r_[0, np.cumsum(ranked[1:] != ranked[:-1])]
    out = np.empty(len(keys), np.int64)
    out[order] = fresh
    return out


class ShardIndex:
    """Index of segments of word numbers (1 and up). Matches do not cross segments.

    Suffixes are sorted as far as ``depth`` words, which is all that backward search for ``depth`` words looks at.
    """

    def __init__(self, words: np.ndarray, lengths: np.ndarray, weights: np.ndarray, depth: int):
        segments = len(lengths)
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        size = len(words) + segments
        text = np.zeros(size, np.int64)
        inside = np.ones(size, bool)
        inside[self.starts + lengths] = False
        text[inside] = words
        self.text, self.lengths, self.depth = text, lengths, depth
        rank, span, shorter = text, 1, None

        def joined(ranks: np.ndarray, shift: int) -> np.ndarray:
            behind = np.zeros(size, np.int64)
            behind[: size - shift] = ranks[shift:] + 1
            return _renumber(ranks * (size + 2) + behind)

        while span * 2 < depth:
            rank, span = joined(rank, span), span * 2
        shorter = joined(rank, depth - 1 - span) if depth - 1 > span else rank
        full = joined(rank, depth - span)
        order = np.argsort(full, kind="stable")
        # all rows that agree in depth - 1 words lie together: that is the interval with the last word dropped
        same = shorter[order]
        edge = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
        self.block_of = np.cumsum(np.r_[False, same[1:] != same[:-1]])
        self.block_start = np.r_[edge, size]
        last = text[order - 1]
        self.bits = max(1, int(text.max()).bit_length())
        self.wavelet = WaveletMatrix(last, self.bits)
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=1 << self.bits))]
        owner = np.repeat(np.arange(segments), lengths + 1)
        self.weight = np.r_[0, np.cumsum(weights[owner][order])]

    def _extend(self, word, low, high):
        base = self.before[word]
        return base + self.wavelet.rank(word, low), base + self.wavelet.rank(word, high)

    def repeated(self, step: int = 128) -> np.ndarray:
        """For every place of the text, whether the ``depth`` words from there occur with a weight of 2 or more.

        Segments stream backwards through the index, all at once and cut into pieces of ``step`` windows. A piece first
        reads ``depth`` words; then each further word drops one at the right and adds one at the left. A segment is part of
        its index, so a match never breaks off.
        """
        out = np.zeros(len(self.text), bool)
        windows = self.lengths - self.depth + 1
        parts = -(-windows // step)
        of = np.repeat(np.arange(len(parts)), parts)
        first = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * step
        many = np.minimum(windows[of] - first, step)
        place = self.starts[of] + first + many + self.depth - 1
        order = np.argsort(-many, kind="stable")
        place, many = place[order], many[order]
        low, high = np.zeros(len(place), np.int64), np.full(len(place), len(self.text), np.int64)
        for k in range(1, (int(many[0]) if len(many) else 0) + self.depth):
            # pieces are ordered by length, so the ones still going are a prefix
            going = int(np.searchsorted(-many, -(k - self.depth + 1), side="right")) if k > self.depth else len(place)
            low, high = low[:going], high[:going]
            if k > self.depth:
                block = self.block_of[low]
                low, high = self.block_start[block], self.block_start[block + 1]
            at = place[:going] - k
            low, high = self._extend(self.text[at], low, high)
            if k >= self.depth:
                out[at] = self.weight[high] - self.weight[low] >= 2
        return out
