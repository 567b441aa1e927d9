"""Word arithmetic on whole Arrow text columns with numpy.

A text column is one byte buffer plus offsets, so words, their hashes and word n-grams of many
documents are found with a few array passes and no Python object per word. Work goes through
pieces of at most ``PIECE`` bytes (or one document), so that arrays stay in cache and memory follows
the piece and the longest document, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 17
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: Bytes that separate words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the longest asked for so far is kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 4096), base, U64)
        have[0] = 1
        _powers[base] = np.multiply.accumulate(have, out=have) if len(have) > 1 else have
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finish of a 64-bit hash, so that all bits depend on all bits."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array without copying; a null is an empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    _, offsets, data = array.buffers()
    if len(array) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind, len(array) + 1, array.offset * np.dtype(kind).itemsize).astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if array.null_count:
        # a null slot may still span bytes: close the gaps
        gone = array.is_null().to_numpy(zero_copy_only=False)
        length = np.where(gone, 0, np.diff(at))
        if (np.diff(at)[gone] > 0).any():
            keep = [buf[a : a + n] for a, n in zip(at[:-1], length, strict=True)]
            return np.concatenate(keep), np.concatenate([[0], np.cumsum(length)])
    return buf, at


class Piece:
    """Words of documents ``first`` to ``last`` of a column.

    ``starts`` and ``ends`` are byte positions in ``buf``; document i (from ``first``) has the
    words ``word_at[i]`` to ``word_at[i + 1]``.
    """

    def __init__(self, buf: np.ndarray, at: np.ndarray, first: int, last: int, space: np.ndarray):
        self.first, self.last = first, last
        self.buf = buf[at[first] : at[last]]
        self.at = at[first : last + 1] - at[first]
        word = ~space[self.buf]
        begins, stops = word.copy(), word.copy()
        if len(word):
            begins[1:] &= ~word[:-1]
            stops[:-1] &= ~word[1:]
            edges = self.at[1:-1]
            edges = edges[(edges > 0) & (edges < len(word))]
            begins[edges] = word[edges]
            stops[edges - 1] = word[edges - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.word_at = np.searchsorted(self.starts, self.at)

    def __len__(self) -> int:
        return self.last - self.first

    def word_hashes(self, table: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of every word: a polynomial over its bytes, read from prefix sums."""
        buf = self.buf if table is None else table[self.buf]
        total = np.zeros(len(buf) + 1, U64)
        np.cumsum((buf.astype(U64) + U64(1)) * powers(_BASE, len(buf)), out=total[1:])
        h = (total[self.ends] - total[self.starts]) * powers(_INVERSE, len(buf) + 1)[self.starts]
        return mix(h ^ (self.ends - self.starts).astype(U64))

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sum per document of one value per byte."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return np.diff(total[self.at])


def pieces(array: pa.Array, space: np.ndarray = SPACE, most: int = PIECE) -> Iterator[Piece]:
    """The column in runs of whole documents of about ``most`` bytes."""
    buf, at = column(array)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
        last = min(last, n)
        yield Piece(buf, at, first, last, space)
        first = last


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes; position i covers i .. i + k - 1."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, k, U64)
    for j in range(k):
        out = (out + h[j : j + n]) * U64((0xD6E8FEB86659FD93 + 2 * j * 0x9FB21C651E98DF25) & 0xFFFFFFFFFFFFFFFF | 1)
    return mix(out)


def inside(word_at: np.ndarray, n_words: int, k: int) -> np.ndarray:
    """Whether the k words from each position lie in one document (n_words - k + 1 positions)."""
    n = max(0, n_words - k + 1)
    ok = np.ones(n, bool)
    for edge in word_at[1:-1]:
        if edge:  # positions edge-k+1 .. edge-1 would cross it
            ok[max(0, edge - k + 1) : min(n, edge)] = False
    return ok


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Positions 0..n-1 inside any window of k from a start."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + k, n), -1)
    return np.cumsum(step[:n]) > 0
