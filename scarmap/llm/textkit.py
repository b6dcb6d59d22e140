"""Words of whole texts as numpy arrays, for use inside Arrow tasks.

A batch of texts is worked on in blocks of about ``BLOCK`` bytes, so that what a task holds beside its
Arrow batch is bounded by the block or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
# Odd base and seeds of the word hash; any odd numbers would do.
BASE = np.uint64(0x9E3779B97F4A7C15)
ODD = np.random.default_rng(20).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CODE = np.random.default_rng(21).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: A-Z to a-z, byte by byte
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes inside the given closed ranges."""
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: everything but blank, tab and line breaks
VISIBLE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: digits, lower-case letters and all characters beyond ASCII; texts are folded before
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (int(BASE), pow(int(BASE), -1, 1 << 64)):
        p = np.full(BLOCK + 1, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def text_blocks(column: pa.Array, block: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets) of consecutive rows; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = pc.fill_null(column, "").cast(pa.large_binary())
    n = len(flat)
    if n == 0:
        return
    offsets = np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset : flat.offset + n + 1]
    data = np.frombuffer(flat.buffers()[2] or b"", dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + block, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def find_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """(start, end) of every word and, for every row, where its words begin in these arrays."""
    inside = is_word[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    begin[first], end[last] = inside[first], inside[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: a polynomial in random codes of its bytes, mixed with its length."""
    power, inverse = _powers()
    out = np.zeros(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        a = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, a + BLOCK, "right")))
        b = ends[j - 1]
        if b - a <= BLOCK:
            values = CODE[data[a:b]]
            values *= power[: b - a]
            total = np.zeros(b - a + 1, dtype=np.uint64)
            np.cumsum(values, out=total[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = (total[e] - total[s]) * inverse[s]
        else:  # one word longer than a block
            h = 0
            for p in range(a, b, BLOCK):
                part = CODE[data[p : min(p + BLOCK, b)]]
                h += int((part * power[: len(part)]).sum(dtype=np.uint64)) * pow(int(BASE), int(p - a), 1 << 64)
            out[i] = np.uint64(h % (1 << 64))
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * ODD[63])


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, row offsets into them) of a block of texts, A-Z folded."""
    folded = LOWER[data]
    starts, ends, rows = find_words(folded, offsets, is_word)
    return hash_words(folded, starts, ends), rows


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries, rows disregarded: entry i stands for i .. i + k - 1."""
    n = max(len(h) - k + 1, 0)
    out = np.full(n, np.uint64(k), dtype=np.uint64)
    for j in range(k):
        out += h[j : j + n] * ODD[j]
    return mix(out)


def row_of(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def row_grams(h: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every k-gram that lies inside one row."""
    g = grams(h, k)
    rows = row_of(offsets)
    at = np.flatnonzero(rows[: len(g)] == rows[k - 1 :]) if len(g) else np.zeros(0, dtype=np.int64)
    return g[at], at


def shingle_sets(h: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct k-gram hashes; a row of fewer words, but not none, is one gram."""
    g, at = row_grams(h, offsets, k)
    cuts = np.searchsorted(at, offsets)
    out = []
    for i in range(len(offsets) - 1):
        a, b = offsets[i], offsets[i + 1]
        if 0 < b - a < k:
            out.append(grams(h[a:b], int(b - a)))
        else:
            out.append(np.unique(g[cuts[i] : cuts[i + 1]]))
    return out


def text_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Shingle sets of a column of texts, words being runs of visible characters."""
    for _, _, data, offsets in text_blocks(column):
        yield from shingle_sets(*words_of(data, offsets, VISIBLE), k)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def step(j: int) -> np.uint64:
    """The j-th of a sequence of well spread numbers."""
    return np.uint64(j * int(BASE) % (1 << 64))
