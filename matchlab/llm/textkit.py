"""Words and hashes of whole Arrow text columns, computed on their bytes with numpy.

A column is worked through in slices of a few megabytes, so memory does not follow the batch or the
text. Null texts count as empty. Hashes are 64 bit; two different words meet with chance 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

SLICE = 2 << 20
#: Bytes that are hashed together, so that their sums stay in a core's cache.
PART = 1 << 16

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that separate words: white space, or all ASCII but letters and digits.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of unsigned 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers[0], _powers[1]


def large_binary(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_string()).cast(pa.large_binary()) if pa.types.is_string(column.type) else column.cast(pa.large_binary())
    return column.fill_null(b"") if column.null_count else column


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows in them); a longer text stands alone."""
    column = large_binary(column)
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the index of its first word (one entry more than rows)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    edge[offsets] = True
    edge[1:-1] |= inside[1:] != inside[:-1]
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    keep = inside[starts]
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans are in ascending order."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + PART, "right")))
        stop = int(ends[j - 1])
        up, down = _power_tables(stop - base + 1)
        sums = np.empty(stop - base + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[data[base:stop]] * up[: stop - base], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = BLANK, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the index of each row's first word."""
    if lower:
        data = LOWER[data]
    starts, ends, first = words(data, offsets, separator)
    return hash_spans(data, starts, ends), first


def distinct_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words of the lower-cased bytes by code: those bytes, starts, ends, the index of each row's first word, the code of each word, and the hash and one place of each code."""
    low = LOWER[data]
    starts, ends, first = words(low, offsets)
    code, hashes = pd.factorize(hash_spans(low, starts, ends))
    where = np.empty(len(hashes), np.int64)
    where[code] = np.arange(len(code))
    return low, starts, ends, first, code, hashes, where


def windows(hashes: np.ndarray, pattern: tuple[int, ...]) -> np.ndarray:
    """A hash of the words at the given places of each window; a window starts at every word that has room."""
    n = len(hashes) - pattern[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, len(pattern), np.uint64)
    for k in pattern:
        acc *= np.uint64(0xD6E8FEB86659FD93)
        acc += hashes[k : k + n]
    return mix(acc)


def hash_words(text: str, separator: np.ndarray = BLANK) -> np.ndarray:
    """Word hashes of one lower-cased text, as a column would give them."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]), separator)[0]
