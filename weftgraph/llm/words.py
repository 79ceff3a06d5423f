"""Texts of a batch as flat numpy arrays: words, their hashes, and hashes of word windows.

A word is a run of bytes other than space and the controls 9 to 13, in UTF-8 that is the same as
``[^\\x20\\x09-\\x0D]+`` over code points. Hashes are polynomials modulo 2**64 with odd bases,
taken from running sums, so a window of any length costs two look-ups. Long spans of bytes are digested
instead: there are texts of 1,024 bytes that no such polynomial tells apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled together inside a task; bounds the temporary arrays (about 60 times as much).
SLICE_BYTES = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
MASK = (1 << 64) - 1
#: A random odd weight for each byte value.
BYTE_WEIGHT = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64, kept for the next batch unless one long text asked for more."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(1024, n)
        known = np.ones(size, np.uint64)
        done = 1
        while done < size:
            step = np.uint64(pow(base, done, 1 << 64))
            more = min(done, size - done)
            known[done : done + more] = known[:more] * step
            done += more
        if size <= 2 * SLICE_BYTES:
            _POWERS[base] = known
    return known[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the result (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def running(values: np.ndarray, base: int) -> np.ndarray:
    """Running sums of ``values[i] * base ** i``, with a leading zero."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return sums


def spans(sums: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span ``values[start:end]``, the same wherever the span lies."""
    h = (sums[ends] - sums[starts]) * powers(inverse(base), len(sums))[starts]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return mix(h)


#: Bytes from which a span is digested; the polynomial fails from 1,024 on.
LONG_SPAN = 256


def byte_spans(data: np.ndarray, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes; ``sums`` are the running sums of ``BYTE_WEIGHT[data]``."""
    hashes = spans(sums, BYTE_BASE, starts, ends)
    for i in np.flatnonzero(ends - starts >= LONG_SPAN):
        found = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8)
        hashes[i] = int.from_bytes(found.digest(), "little")
    return hashes


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def cuts(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (a longer single text makes a range of its own)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


class Words:
    """The words of consecutive texts. ``bounds[i]:bounds[i + 1]`` are the words of text ``i``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.offsets = offsets
        self.data = LOWER[data] if lower else data
        inside = ~SPACE[data]
        opens = np.zeros(len(data) + 1, bool)
        closes = np.zeros(len(data) + 1, bool)
        if len(data):
            edge = np.zeros(len(data) + 1, bool)
            edge[offsets] = True
            opens[0] = inside[0]
            opens[1:-1] = inside[1:] & (~inside[:-1] | edge[1:-1])
            closes[1:-1] = inside[:-1] & (~inside[1:] | edge[1:-1])
            closes[-1] = inside[-1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes)
        self.bounds = np.searchsorted(self.starts, offsets)
        self._sums: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @property
    def byte_sums(self) -> np.ndarray:
        if self._sums is None:
            self._sums = running(BYTE_WEIGHT[self.data], BYTE_BASE)
        return self._sums

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        return byte_spans(self.data, self.byte_sums, self.starts, self.ends)

    def windows(self, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of ``size`` words that lies in one text."""
        n = len(hashes)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = np.repeat(self.bounds[1:], self.counts)
        first = np.flatnonzero(np.arange(n) + size <= last)
        return first, spans(running(hashes, WORD_BASE), WORD_BASE, first, first + size)


def sliced(column: pa.Array, lower: bool = True, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """The words of a column, a bounded number of bytes at a time: first row, end row, words."""
    data, offsets = buffers(column)
    for at, to in cuts(offsets, most):
        part = offsets[at : to + 1]
        yield at, to, Words(data[part[0] : part[-1]], part - part[0], lower)
