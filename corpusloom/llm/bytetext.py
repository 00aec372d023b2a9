"""Vectorised work on UTF-8 bytes of Arrow string columns.

Texts stay in Arrow's buffers; numpy finds words, hashes them with a polynomial
prefix hash and combines neighbouring word hashes into shingle hashes. No Python
object is made per word, so a pass costs some tens of nanoseconds per byte and
holds a few arrays of one slice (about ``SLICE_BYTES`` of text, or one longer
document) at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

#: ASCII white space: \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_SPACE = ~SPACE
#: a-z, A-Z, 0-9 and every non-ASCII byte.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Letters; every non-ASCII byte counts as part of one.
LETTER = ALNUM.copy()
LETTER[48:58] = False
#: Maps A-Z to a-z and leaves other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))
_LOWER_CODE = _BYTE_CODE[LOWER]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        for k, base in enumerate((_BASE, _INVERSE)):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _powers[k] = np.multiply.accumulate(run)
    out = _powers[0][:n], _powers[1][:n]
    if n > 4 * SLICE_BYTES:  # a rare very long text: don't keep its table
        _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    return out


@dataclass
class Slice:
    """Rows ``lo:hi`` of a batch; ``off`` has the byte offsets of their texts in ``buf``."""

    lo: int
    hi: int
    buf: np.ndarray
    off: np.ndarray

    def __len__(self) -> int:
        return self.hi - self.lo


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into runs of rows of about ``limit`` bytes; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield Slice(lo, hi, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


@dataclass
class Words:
    """Words of a slice: byte ranges, hashes, and ``ptr[d]:ptr[d + 1]`` as the words of document d."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    ptr: np.ndarray

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def words(s: Slice, member: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    """Maximal runs of bytes in ``member``, never across documents; A-Z count as a-z if ``lower``."""
    n = len(s.buf)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(s) + 1, np.int64))
    inside = member[s.buf]
    cut = np.zeros(n + 1, bool)
    cut[s.off] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], after[-1] = False, False
    before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & (~before | cut[:n]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    up, down = _power(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER_CODE if lower else _BYTE_CODE)[s.buf] * up[:n], out=total[1:])
    h = mix((total[end] - total[start]) * down[start])
    return Words(start, end, h, np.searchsorted(start, s.off).astype(np.int64))


def windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of k words inside one document."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _STEP + w.hash[j : j + n]
    last = np.repeat(w.ptr[1:], np.diff(w.ptr))[:n]
    at = np.flatnonzero(np.arange(k, n + k) <= last)
    return mix(h[at]), at


def sums(per_byte: np.ndarray, s: Slice) -> np.ndarray:
    """Sum of a boolean or small integer per byte over each document."""
    total = np.zeros(len(per_byte) + 1, np.int64)
    np.cumsum(per_byte, out=total[1:])
    return total[s.off[1:]] - total[s.off[:-1]]


def unique_pairs(doc: np.ndarray, key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, key) pairs in order, with their counts; key < 2**bits."""
    both = (doc.astype(np.uint64) << np.uint64(bits)) | key.astype(np.uint64)
    both.sort()
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
    one = both[first]
    count = np.diff(np.append(first, len(both)))
    return (one >> np.uint64(bits)).astype(np.int64), (one & np.uint64((1 << bits) - 1)).astype(np.int64), count
