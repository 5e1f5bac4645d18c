"""Words of many texts at once as arrays: places and 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20_240_607)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_PLACE = _RANDOM.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
_FACTOR = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)

#: Bytes that are part of a word: anything but blanks; letters, digits and all beyond ASCII.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts(column: pa.Array, most_bytes: int = 1 << 22) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about most_bytes of text: first row, end row, UTF-8 bytes, and where each row starts in
    them, with the end last. Null is empty. A single longer text is a run of its own."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1 + column.offset)[column.offset :]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None and held.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most_bytes, side="right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def _first(inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether each byte is a word's first; no word goes on from one row to the next."""
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = starts[:-1][starts[:-1] < len(inside)]
    begins[edge] = inside[edge]
    return begins


def words(data: np.ndarray, starts: np.ndarray, kind: np.ndarray, byte: np.ndarray = _BYTE, section: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z as a-z, and how many words lie before each row, with their total last. With other
    numbers for bytes, one for each, words are told apart as they are written."""
    inside = kind[data]
    begin = np.flatnonzero(_first(inside, starts))
    before = np.searchsorted(begin, starts)
    hashes = np.empty(len(begin), dtype=np.uint64)
    lo = 0
    while lo < len(begin):  # whole words, about a section of bytes at a time
        hi = max(lo + 1, int(np.searchsorted(begin, begin[lo] + section)))
        a, b = begin[lo], begin[hi] if hi < len(begin) else len(data)
        own = begin[lo:hi] - a
        place = np.arange(b - a) - np.repeat(own, np.diff(np.append(own, b - a)))
        value = byte[data[a:b]] * _PLACE[place & 4095]
        if place.max() > 4095:
            value = value * _FACTOR[(place >> 12) & 63]
        value[~inside[a:b]] = 0
        hashes[lo:hi] = mix(np.add.reduceat(value, own))
        lo = hi
    return hashes, before


def word_places(data: np.ndarray, starts: np.ndarray, kind: np.ndarray = NOT_BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end."""
    inside = kind[data]
    begins = _first(inside, starts)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins[1:]
    return np.flatnonzero(begins), np.flatnonzero(last) + 1


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of size words; runs may cross rows, so the caller picks those that do not."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total += mix(hashes[i : i + n] + _FACTOR[i % 64]) * _FACTOR[(i + 17) % 64]
    return mix(total)


def row_grams(hashes: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the first gram and how many it has, in grams(hashes, size)."""
    return before[:-1], np.maximum(0, np.diff(before) - size + 1)
