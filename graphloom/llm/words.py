"""Words and their hashes over whole Arrow columns, without a Python loop per word.

A slice is a run of rows whose texts lie one after another in one byte buffer. Everything is computed
on bytes: all bytes of a character outside ASCII are 0x80 or more, so the byte classes below give the
same words as the character classes they stand for.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_ROWS = 4096

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Letters, digits and everything outside ASCII.
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_BYTES >= 128)
#: Everything but white space.
NONSPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))

_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


class _Kept(dict):
    """Values that a process makes for itself; they do not travel with the functions that use them."""

    def __reduce__(self):
        return _Kept, ()


_powers = _Kept()


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64; grows as longer texts come."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        size = max(1 << 16, 1 << (count - 1).bit_length())
        known = np.full(size, base, np.uint64)
        known[0] = 1
        _powers[base] = known = np.cumprod(known)
    return known[:count]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; starts ascend, spans may overlap, none is empty."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(starts, first + SLICE_BYTES)))
        s, e = starts[at:upto] - first, ends[at:upto] - first
        size = int(e.max())
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(BYTE_CODES[data[first:first + size]] * powers(_BASE, size), out=total[1:])
        out[at:upto] = mix((total[e] - total[s]) * powers(_UNBASE, size + 1)[s] + (e - s).astype(np.uint64))
        at = upto
    return out


class Slice(NamedTuple):
    first: int              # row of the batch
    data: np.ndarray        # bytes of all rows
    offsets: np.ndarray     # row i is data[offsets[i]:offsets[i + 1]]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Rows of a text column in slices of about ``limit`` bytes; a longer row is alone. Null is empty."""
    for first in range(0, len(column), _ROWS):
        for part in _sliced(column.slice(first, _ROWS), limit):
            yield part._replace(first=part.first + first)


def _sliced(column: pa.Array, limit: int) -> Iterator[Slice]:
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, where, values = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        begin, end = int(offsets[first]), int(offsets[last])
        yield Slice(first, data[begin:end], offsets[first:last + 1] - begin)
        first = last


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray        # words of row i are rows[i]:rows[i + 1]


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    """Maximal runs of bytes of a class; none crosses two rows."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[data]
    before, after = inside[:-2].copy(), inside[2:].copy()
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    here = inside[1:-1]
    starts = np.flatnonzero(here & ~before)
    ends = np.flatnonzero(here & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


_PLACE = mix(np.arange(101, 165, dtype=np.uint64)) | np.uint64(1)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` word hashes, wherever it starts (runs over row ends included)."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, length, np.uint64)
    for j in range(length):
        total += hashes[j:j + count] * _PLACE[j % 64]
    return mix(total)


def within_rows(rows: np.ndarray, length: int) -> np.ndarray:
    """Of the windows of ``length`` words in order of their starts, which lie in one row."""
    of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    return of[:max(0, len(of) - length + 1)] == of[length - 1:]
