"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, with A-Z lower-cased.
Work goes through slices of a few MB, whatever the size of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_RNG = np.random.Generator(np.random.PCG64(20240131))
_LETTER = _RNG.integers(1, 2**64, 256, dtype=np.uint64, endpoint=False) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER[_SPACE] = 0
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_KEPT: dict[int, np.ndarray] = {}


def _kept_powers(base: int, n: int) -> np.ndarray:
    """``powers`` for slices, worked out once in a process for all but single long texts."""
    if n > SLICE_BYTES:
        return powers(base, n)
    if base not in _KEPT:
        _KEPT[base] = powers(base, SLICE_BYTES)
    return _KEPT[base][:n]


class Words(NamedTuple):
    """Words of one slice. ``doc`` numbers documents from 0 within the slice."""

    data: np.ndarray  # lower-cased bytes
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # per document, the index of its first word; one more entry at the end

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same in every process."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        n = len(self.data)
        part = _LETTER[self.data] * _kept_powers(_BASE, n)
        total = np.add.reduceat(part, self.start)
        return mix(total * _kept_powers(_INVERSE, n)[self.start] + (self.end - self.start).astype(np.uint64))

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the documents whose bytes lie between consecutive ``offsets``."""
    low = _LOWER[data]
    inside = ~_SPACE[low]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(low))]
    begins[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(low, doc, start, end, first)


def _punctuation(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to ASCII punctuation, U+2000 to U+207F or one of the marks of C2 A1, AB, BB and BF."""
    marks = _PUNCTUATION[data]
    lead = np.flatnonzero(data >= 0xC2)
    lead = lead[lead < len(data) - 1]
    two = lead[(data[lead] == 0xC2) & np.isin(data[lead + 1], (0xA1, 0xAB, 0xBB, 0xBF))]
    three = lead[(data[lead] == 0xE2) & ((data[lead + 1] == 0x80) | (data[lead + 1] == 0x81))]
    three = three[three < len(data) - 2]
    for at, size in ((two, 2), (three, 3)):
        for j in range(size):
            marks[at + j] = True
    return marks


def bare(words: Words) -> Words:
    """The words without punctuation before and after them; a word of punctuation alone stays as it is."""
    if not len(words.start):
        return words
    marks = _punctuation(words.data)
    some = np.flatnonzero(marks[words.start] | marks[words.end - 1])
    inner = np.flatnonzero(~(marks | _SPACE[words.data]))
    if not len(some) or not len(inner):
        return words
    a, b = words.start[some], words.end[some]
    low, high = np.searchsorted(inner, a), np.searchsorted(inner, b)
    fit = low < high
    some, a, b, low, high = (x[fit] for x in (some, a, b, low, high))
    start, end = words.start.copy(), words.end.copy()
    start[some], end[some] = inner[low], inner[high - 1] + 1
    # What was cut reads as space, since hashes sum up to the next word.
    cut = np.zeros(len(words.data) + 1, np.int8)
    for at, by in ((a, 1), (start[some], -1), (end[some], 1), (b, -1)):
        cut[at] += by
    data = words.data.copy()
    data[np.cumsum(cut[:-1], dtype=np.int8) > 0] = 32
    return words._replace(data=data, start=start, end=end)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of parts of a text column; NULL reads as empty.

    A part has at most ``limit`` bytes unless it is a single longer text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive ones of ``h``."""
    out = np.full(max(0, len(h) - k + 1), 0x51, np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(_BASE) + h[j:j + len(out)])
    return out


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-word shingle in order, per document the index of its first one).

    A document with fewer than k words, but at least one, has its whole sequence as one.
    """
    h = words.hashes()
    n = np.diff(words.first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n)), count)
    at = words.first[:-1][doc] + np.arange(first[-1]) - first[:-1][doc]
    size = np.minimum(n, k)[doc]
    out = np.full(len(at), 0x51, np.uint64)
    for j in range(k):
        take = size > j
        step = h[np.where(take, at + j, 0)] if len(h) else np.zeros(0, np.uint64)
        out = np.where(take, mix(out * np.uint64(_BASE) + step), out)
    return out, first
