"""Vectorised text primitives over Arrow string buffers.

A *word* is a maximal run of bytes in 0-9, A-Z, a-z or 0x80-0xFF, so every
non-ASCII character belongs to a word; A-Z are lower-cased, nothing else is.
All work is done on the concatenated UTF-8 bytes of a batch with numpy, so the
cost for each byte is a few nanoseconds and no Python string is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: An odd multiplier has an inverse mod 2**64, which makes prefix hashes divisible.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
_MIX = U64(0xFF51AFD7ED558CCD)

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x41:0x5B] = WORD_BYTE[0x61:0x7B] = True
WORD_BYTE[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i mod 2**64 for i < n, kept and grown by doubling."""
    have = _tables.get("pow")
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("pow", BASE), ("inv", BASE_INV)):
            out = np.ones(size, U64)
            k, step = 1, base
            while k < size:
                out[k : 2 * k] = out[:k] * U64(step)
                step, k = step * step % (1 << 64), 2 * k
            _tables[name] = out
    return _tables["pow"], _tables["inv"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = h ^ (h >> U64(32))
    h = h * _MIX
    return h ^ (h >> U64(29))


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def eights(s: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, the first the lowest; bytes behind the end are 0."""
    n = len(s)
    padded = np.zeros(-(-n // 8) * 8 + 16, np.uint8)
    padded[:n] = s
    out = np.empty(len(padded) - 8, U64)
    for o in range(8):
        out[o::8] = padded[o : o + len(out[o::8]) * 8].view("<u8")
    return out


def buffers(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (starting at 0) of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges holding just under `limit` bytes each at most; one longer row stands alone."""
    a, n, limit = 0, len(offsets) - 1, limit - 64  # so tables of the next power of two suffice
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


@dataclass
class Words:
    """Words of a batch: byte ranges, 64-bit hashes of the lower-cased bytes, and the first word of each row."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # len(rows) + 1
    lower: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def text(self, i: int) -> bytes:
        return self.lower[self.start[i] : self.end[i]].tobytes()


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Split the rows of a batch into words; words never cross rows."""
    n = len(data)
    lower = LOWER[data]
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(0, U64), np.zeros(len(offsets), np.int64), lower)
    is_word = WORD_BYTE[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, is_word[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, is_word[1:]
    before[offsets[offsets < n]] = False
    cut = offsets[offsets > 0]
    after[cut - 1] = False
    start = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    power, inverse = _powers(n + 1)
    total = np.empty(n + 1, U64)
    total[0] = 0
    np.cumsum((lower.astype(U64) + U64(1)) * power[:n], out=total[1:])
    h = mix((total[end] - total[start]) * inverse[start])
    return Words(start, end, h, np.searchsorted(start, offsets), lower)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row, and the first shingle of each row (len(rows) + 1).

    A row of fewer than k words, but not none, has one shingle of all its words.
    """
    counts, n = w.counts(), len(w.hash)
    if n == 0:
        return np.zeros(0, U64), np.zeros(len(w.first), np.int64)
    acc = np.zeros(n, U64)
    short_end = np.repeat(w.first[1:], counts)
    index = np.arange(n)
    for j in range(k):
        at = index + j
        inside = at < short_end
        acc = np.where(inside, mix(acc * U64(BASE) + w.hash[np.minimum(at, n - 1)]), acc)
    per_row = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    local = index - np.repeat(w.first[:-1], counts)
    keep = local < np.repeat(per_row, counts)
    first = np.zeros(len(w.first), np.int64)
    np.cumsum(per_row, out=first[1:])
    return acc[keep], first
