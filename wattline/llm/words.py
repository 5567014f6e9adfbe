"""Words and shingles of Arrow text columns as 64-bit hashes, by array operations.

A word is a run of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased; both rules touch single bytes of
UTF-8 only, so the bytes are hashed without decoding. Two different words or shingles get the same
64 bits with a probability of about 2^-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
GAMMA = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, size: int) -> np.ndarray:
    """``size`` fixed pseudo-random 64-bit numbers."""
    first = np.uint64((seed * 0x632BE59BD9B4E019 + 1) % (1 << 64))
    return mix(first + np.arange(1, size + 1, dtype=np.uint64) * GAMMA)


_BYTE = stream(1, 256)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = int(stream(2, 1)[0]) | 1
_powers = np.ones(1, np.uint64)


def _power(count: int) -> np.ndarray:
    global _powers
    if len(_powers) < count:
        _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * count, _BASE, np.uint64))])
    return _powers


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column end to end, and the n + 1 limits of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    limits = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[limits[0] : limits[-1]], limits - limits[0]


def _cuts(data: np.ndarray, rows: np.ndarray, gap: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of about SEGMENT bytes that end where a word cannot go on."""
    low = 0
    while low < len(data):
        high = min(low + SEGMENT, len(data))
        while high < len(data):
            at = int(rows[np.searchsorted(rows, high, "right") - 1])
            if at > low:
                high = at
                break
            blank = np.flatnonzero(gap[data[low:high]])
            if len(blank):
                high = low + int(blank[-1]) + 1
                break
            high = min(high + SEGMENT, len(data))
        yield low, high
        low = high


def spans(
    data: np.ndarray, rows: np.ndarray, gap: np.ndarray = _BLANK, byte: np.ndarray = _BYTE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first byte of every word, and the n + 1 limits of the rows among the words.

    ``gap`` tells the bytes between words, ``byte`` gives each byte's part in the hash.
    """
    hashes, firsts = [], []
    begins = rows[:-1]
    for low, high in _cuts(data, rows, gap):
        part = data[low:high]
        solid = ~gap[part]
        fresh = np.empty(len(part), bool)
        fresh[0] = True
        fresh[1:] = ~solid[:-1]
        inside = begins[np.searchsorted(begins, low) : np.searchsorted(begins, high)]
        fresh[inside - low] = True
        first = solid & fresh
        at = np.flatnonzero(first)
        if not len(at):
            continue
        place = np.flatnonzero(solid)
        word = np.cumsum(first)[place] - 1
        depth = place - at[word]
        value = byte[part[place]] * _power(int(depth.max()) + 1)[depth]
        hashes.append(mix(np.add.reduceat(value, np.searchsorted(place, at))))
        firsts.append(at + low)
    found = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    first = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    return found, first, np.searchsorted(first, rows)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows end to end, and the limits of the rows."""
    found, _, limits = spans(*utf8(column))
    return found, limits


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; of the whole sequence if it is shorter; none of nothing."""
    count = len(words)
    if not count:
        return words
    width = min(size, count)
    total = np.zeros(count - width + 1, np.uint64)
    for i, factor in enumerate(stream(3, width) | np.uint64(1)):
        total += words[i : count - width + 1 + i] * factor
    # A short sequence must not equal the same words as part of a longer shingle.
    return mix(total + np.uint64(width))


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each row."""
    words, limits = word_hashes(column)
    for low, high in zip(limits[:-1], limits[1:]):
        yield np.unique(shingles(words[low:high], size))


def release() -> None:
    """Give freed memory back: Python workers live on from task to task, beside others and the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def batches(column: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about ``most`` bytes of text, one row at least."""
    _, limits = utf8(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(limits, limits[low] + most, "right")) - 1)
        yield low, min(high, len(column))
        low = high
    release()
