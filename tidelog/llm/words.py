"""Vectorized word work on Arrow string columns: positions, hashes, shingles.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09`` to ``\\x0D``; hashes see
A-Z lower-cased. All arrays are flat over a slice of rows, with ``first`` giving where
the words of each row begin. Slices hold about a megabyte of text, or one longer text,
and long texts are hashed in segments, so memory does not follow the batch size.

Hashes are 64-bit: a polynomial over random byte values, then mixed. Two different words
share one with a chance near 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15
BASE = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _table(lower: bool) -> np.ndarray:
    codes = np.arange(256)
    if lower:
        codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    return mix((codes.astype(U64) + U64(1)) * U64(_ODD))


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Blanks and every other ASCII character but letters and digits.
MARKS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
LOWERED, EXACT = _table(True), _table(False)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for ``i`` below ``n`` at least."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE + 4096), base, dtype=U64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def span_hashes(data: np.ndarray, start, end, table: np.ndarray = LOWERED) -> np.ndarray:
    """A hash of ``data[start:end]`` for every span; spans ascend and do not overlap."""
    out = np.empty(len(start), dtype=U64)
    low = 0
    while low < len(start):
        # as many spans as lie in one segment, one at least
        high = max(low + 1, int(np.searchsorted(end, start[low] + SLICE, "right")))
        base, top = int(start[low]), int(end[high - 1])
        prefix = np.zeros(top - base + 1, dtype=U64)
        np.cumsum(table[data[base:top]] * powers(BASE, top - base), out=prefix[1:])
        s, e = start[low:high] - base, end[low:high] - base
        back = powers(INVERSE, top - base)
        body = (prefix[e] - prefix[s]) * back[s]
        out[low:high] = mix(body + (e - s).astype(U64) * U64(_ODD))
        low = high
    return out


@dataclass
class Slice:
    """Rows ``low`` to ``high`` of a batch: their bytes, and where each row's begin."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray


def slices(column: pa.Array) -> Iterator[Slice]:
    """The rows of a string column in slices of bounded size; NULL reads as empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, bounds, body = column.buffers()
    offsets = np.frombuffer(bounds, width)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + SLICE, "right")) - 1
        high = min(max(high, low + 1), len(column))
        yield Slice(low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


@dataclass
class Words:
    """Byte spans of the words of a slice; row ``r`` has those from ``first[r]`` on."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def find_words(part: Slice, blank: np.ndarray = SPACE) -> Words:
    """Words are the runs of bytes that ``blank`` does not mark."""
    inside = ~blank[part.data]
    n = len(inside)
    edges = part.offsets[part.offsets < n]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(start, end, np.searchsorted(start, part.offsets))


def find_lines(part: Slice, words: Words) -> Words:
    """Spans of the lines that hold a word, without surrounding blanks; and their rows."""
    if not len(words.start):
        return Words(words.start, words.end, np.zeros(len(words.first), dtype=np.int64))
    breaks = np.flatnonzero(part.data == 0x0A)
    line = np.searchsorted(breaks, words.start)
    begins = np.ones(len(line), dtype=bool)
    begins[1:] = line[1:] != line[:-1]
    begins[words.first[:-1][words.counts > 0]] = True
    at = np.flatnonzero(begins)
    last = np.append(at[1:], len(line)) - 1
    return Words(words.start[at], words.end[last], np.searchsorted(at, words.first))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive hashes, in order; ``len - k + 1`` of them."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    total = np.full(n, k, dtype=U64)
    for i in range(k):
        total *= U64(BASE)
        total += hashes[i : i + n]
    return mix(total)


def row_grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-grams inside rows, and where each row's begin.

    A row with fewer than ``k`` values, but one at least, has its whole sequence as one.
    """
    counts = np.diff(first)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(begin[-1], dtype=U64)
    grams = gram_hashes(hashes, k)
    long = counts >= k
    rows = np.repeat(np.arange(len(counts)), n)
    position = first[rows] + np.arange(len(rows)) - begin[rows]
    wide = long[rows]
    out[wide] = grams[position[wide]]
    for r in np.flatnonzero((counts > 0) & ~long):
        own = hashes[first[r] : first[r + 1]]
        out[begin[r]] = gram_hashes(own, len(own))[0]
    return out, begin
