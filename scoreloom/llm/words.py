"""Words and word shingles of Arrow text columns as numpy arrays of hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)

# Bytes of a word; every other byte separates. UTF-8 bytes of other letters are >= 0x80.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LETTER_OR_DIGIT = np.zeros(256, bool)
LETTER_OR_DIGIT[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
AS_IS = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of consecutive rows with about ``limit`` bytes together.

    Null counts as empty. A longer text is a slice of its own; texts are never cut.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(inside, starts, ends, of)``: the word bytes, and byte span and row of each word."""
    inside = in_word[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, inside
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    start = inside & ~before[:-1]
    start[cut] = inside[cut]
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    end = inside & ~after[1:]
    end[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    of = np.searchsorted(offsets, starts, "right") - 1
    return inside, starts, ends, of


def word_hashes(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = AS_IS) -> np.ndarray:
    """A 64-bit hash per word, of its bytes after ``fold``."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _STEP, np.uint64))
    values = _BYTE_VALUE[fold[data[inside]]] * powers[place]
    return mix(np.add.reduceat(values, first) ^ (lengths.astype(np.uint64) * _GOLDEN))


def _factors(k: int) -> np.ndarray:
    """Odd multipliers, one per word of a shingle."""
    return mix(np.arange(1, k + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes, in order."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, factor in enumerate(_factors(k)):
        out += words[j : j + n] * factor
    return mix(out)


def texts_of_words(column: pa.Array, in_word: np.ndarray, fold: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, rows, word hashes, bounds)`` per slice; row i has words ``bounds[i]:bounds[i + 1]``."""
    for first, data, offsets in text_slices(column):
        inside, starts, ends, _ = word_spans(data, offsets, in_word)
        yield first, len(offsets) - 1, word_hashes(data, inside, starts, ends, fold), np.searchsorted(starts, offsets)
