"""FM-index of short symbol sequences: packed wavelet matrix over the Burrows-Wheeler transform.

Sequences are joined by separators that differ from each other, so suffixes sort fully within the
longest sequence. Rank queries and backward search run for many patterns at once.
"""

from __future__ import annotations

import numpy as np


class Wavelet:
    """Rank over a sequence of symbols below 2**bits, one packed bit vector per level."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.words, self.before, self.zeros = [], [], []
        now = values.astype(np.uint32)
        for level in range(bits):
            bit = (now >> np.uint32(bits - 1 - level) & np.uint32(1)).astype(bool)
            packed = np.zeros(-(-(len(bit) + 1) // 64) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[: len(raw)] = raw
            words = packed.view(np.uint64)
            ones = np.bitwise_count(words).astype(np.uint32)
            self.words.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int64))
            self.zeros.append(int((~bit).sum()))
            now = np.concatenate([now[~bit], now[bit]])
        # where the run of every symbol begins after the last level
        symbols = np.arange(int(values.max()) + 1 if len(values) else 1)
        self.first = self._descend(symbols, np.zeros(len(symbols), np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.bits):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[level][word] + np.bitwise_count(self.words[level][word] & below)
            one = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._descend(symbol, at) - self.first[symbol]


class Index:
    """Sequences of symbols from 1 on, given as one array and their lengths."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        ends = np.cumsum(lengths) + np.arange(len(lengths))
        n = int(lengths.sum()) + len(lengths)
        self.text = np.zeros(n, np.int64)
        body = np.ones(n, bool)
        body[ends] = False
        self.text[body] = symbols
        self.owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        self.starts = ends - lengths
        self.lengths = lengths
        order = suffixes(self.text, ends, int(lengths.max()) + 1 if len(lengths) else 1)
        self.order = order
        self.wavelet = Wavelet(self.text[order - 1], max(1, int(self.text.max()).bit_length()))
        count = np.bincount(self.text, minlength=int(self.text.max()) + 1)
        self.less = np.cumsum(count) - count

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of ``symbol`` followed by what [low, high) stands for."""
        rank = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        n = len(symbol)
        return self.less[symbol] + rank[:n], self.less[symbol] + rank[n:]


def suffixes(text: np.ndarray, separators: np.ndarray, longest: int) -> np.ndarray:
    """Start positions in suffix order, by prefix doubling; every separator is a symbol of its own."""
    rank = text + len(separators)
    rank[separators] = np.arange(len(separators))
    n, k = len(text), 1
    order = np.argsort(rank, kind="stable")
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - k] = rank[k:] + 1 if k < n else 0
        key = rank * (int(rank.max()) + int(follow.max()) + 2) + follow
        order = np.argsort(key, kind="stable")
        new = np.ones(n, bool)
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all():
            return order
        k *= 2


def matching(index: Index, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stream all sequences against the index by backward search.

    For every end position with k symbols before it inside its sequence: (position of the window's
    first symbol, low, high). A position stops when its match is down to one suffix, itself; then
    high = low + 1 stands for "nowhere else", however long the match was.
    """
    n_windows = np.maximum(index.lengths - k + 1, 0)
    first = np.repeat(index.starts, n_windows) + ramp(n_windows)
    low = np.zeros(len(first), np.int64)
    high = np.full(len(first), len(index.text), np.int64)
    live = np.arange(len(first))
    for step in range(k):
        symbol = index.text[first[live] + k - 1 - step]
        low[live], high[live] = index.extend(symbol, low[live], high[live])
        live = live[high[live] - low[live] > 1]
    return first, low, high


def ramp(lengths: np.ndarray) -> np.ndarray:
    """0 .. l-1 for each length, one after the other."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def smallest(index: Index, value: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each window the smallest ``value`` (one per sequence) over all sequences it occurs in."""
    out = value[index.owner[first]].copy()
    more = np.flatnonzero(high - low > 1)
    if len(more):
        by_suffix = np.append(value[index.owner[index.order]], np.iinfo(np.int64).max)
        spans, back = np.unique(np.stack([low[more], high[more]], axis=1), axis=0, return_inverse=True)
        out[more] = np.minimum.reduceat(by_suffix, spans.ravel())[::2][back.ravel()]
    return out
