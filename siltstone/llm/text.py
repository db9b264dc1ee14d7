"""Words and shingles of whole Arrow columns, as numpy arrays.

A column of texts is one byte buffer with offsets. Words, their hashes and the
hashes of word shingles are worked out over that buffer at once, so no Python
object is made per word. Hashes have 64 bits and are the same on every worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once, and bytes hashed at once.
SLICE, BLOCK = 2 << 20, 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the next call."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()

        def table(base: int) -> np.ndarray:
            steps = np.full(size, base & (2**64 - 1), np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)

        _powers = table(_BASE), table(pow(_BASE, -1, 2**64))
    return _powers


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most `size` bytes each, one row at least."""
    low, n = 0, len(bounds) - 1
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + size, "right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high
        low = high


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; the spans are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + BLOCK, "right")))
        first, last = int(starts[low]), int(ends[high - 1])
        power, inverse = _power_table(last - first + 1)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_BYTE[data[first:last]] * power[: last - first], out=sums[1:])
        a, b = starts[low:high] - first, ends[low:high] - first
        out[low:high] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        low = high
    return out


def fold_case(data: np.ndarray) -> np.ndarray:
    """UTF-8 text with A to Z and the capitals of U+00C0 to U+00DE in lower case; no length changes."""
    low = LOWER[data]
    accented = np.zeros(len(low), bool)
    accented[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
    low[accented] += 0x20
    return low


class Words:
    """Words of some texts: byte spans, hashes, and the first word of each text.

    A word is a run of bytes other than space and 0x09 to 0x0D. `first` has one
    more entry than there are texts.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = True, hashed: bool = True):
        self.data = LOWER[data] if lower else data
        word = ~_SPACE[data]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        inner = bounds[:-1][(bounds[:-1] > 0) & (bounds[:-1] < len(data))]
        begins[inner] = word[inner]
        ends[inner - 1] |= word[inner - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, bounds)
        if hashed:
            self.hash()

    def hash(self) -> None:
        self.hashes = span_hashes(self.data, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every k words in a row, and the word each begins at."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(self.first) - 1), self.counts())
        at = np.flatnonzero(owner[:n] == owner[k - 1 :])
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total = total * np.uint64(0x9E3779B97F4A7C15) + self.hashes[j : n + j]
            total ^= total >> np.uint64(32)
        return mix(total[at]), at


def owners(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text that each word position belongs to."""
    return np.searchsorted(first, at, "right") - 1


def code_points_before(data: np.ndarray) -> np.ndarray:
    """Entry i: code points that begin in the first i bytes of UTF-8 text."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
