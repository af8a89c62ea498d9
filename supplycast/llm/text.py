"""Vectorised work on the UTF-8 bytes of Arrow text columns.

A column is seen as one byte buffer plus document offsets.  Words, lines and byte windows are found
with numpy on slices of about 128 KB, so memory does not depend on the size of a batch; a
longer document makes a slice of its own.  Nulls are empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 17
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def byte_set(codes) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(codes)] = True
    return found


#: bytes between words: blank and control blanks
BLANKS = byte_set([0x20, *range(0x09, 0x0E)])
#: bytes between words made of digits, Latin letters and everything beyond ASCII
NOT_ALNUM = byte_set([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: A-Z to a-z
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1B54A32D192ED03))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of them."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and the ``n + 1`` document offsets of a text column, nulls as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[: at[-1]], at


def slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of documents of about ``limit`` bytes: first document, bytes, offsets from zero."""
    data, at = byte_view(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


class Hasher:
    """Hash of any byte range of one slice in constant time."""

    def __init__(self, data: np.ndarray, fold: np.ndarray = SAME) -> None:
        power, self._inverse = _power_tables(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[fold][data] * power[: len(data)], out=self._sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts])

    def windows(self, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes from each position on."""
        if len(self._sums) <= size:
            return np.zeros(0, np.uint64)
        raw = self._sums[size:] - self._sums[:-size]
        return mix(raw * self._inverse[: len(raw)])


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # word k of document d: bounds[d] <= k < bounds[d + 1]


def find_words(data: np.ndarray, offsets: np.ndarray, blanks: np.ndarray = BLANKS) -> Words:
    """Byte ranges of the words of a slice; no word crosses a document border."""
    blank = blanks[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    before = border.copy()
    before[1:] |= blank
    starts = np.flatnonzero(~blank & before[:-1])
    after = border[1:].copy()
    after[:-1] |= blank[1:]
    ends = np.flatnonzero(~blank & after) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def per_document(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of a value between consecutive bounds."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def owners(bounds: np.ndarray) -> np.ndarray:
    """Document number of each element."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(words: np.ndarray, bounds: np.ndarray, size: int, whole: bool = False):
    """Hashes of ``size`` consecutive word hashes inside each document, and their document.

    Returns ``(hashes, documents, positions)`` with the position of the first word.  With ``whole``
    a document of fewer words has one shingle, its whole sequence.
    """
    n, docs = len(words), owners(bounds)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at = np.flatnonzero(np.arange(n) + size <= ends)
    total = np.zeros(len(at), np.uint64)
    step = 1
    for k in range(size):
        total += words[at + k] * _U(step)
        step = step * _BASE % (1 << 64)
    hashes, where = mix(total + _U(size)), docs[at]
    if whole:
        counts = np.diff(bounds)
        few = np.flatnonzero((counts > 0) & (counts < size))
        short = np.zeros(len(few), np.uint64)
        for k in range(1, size):
            has = counts[few] > k - 1
            value = words[np.minimum(bounds[few] + k - 1, max(n - 1, 0))]
            short = np.where(has, mix(short * _U(_BASE) + value + _U(k)), short)
        hashes = np.concatenate([hashes, short])
        where = np.concatenate([where, few])
        at = np.concatenate([at, bounds[few]])
    return hashes, where, at


def keyed(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Hashes that differ between documents."""
    return mix(hashes + mix(docs.astype(np.uint64) + _U(1)))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
