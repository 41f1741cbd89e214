"""Whole columns of text as numpy byte arrays: words, hashes and word runs without a Python object per word.

Every helper works on a *slice*: a few rows of an Arrow batch whose texts lie one after the other in one byte
buffer. A slice holds at most ``SLICE_BYTES`` unless one text alone is longer, so memory is bounded by the
longest text and not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

U64 = np.uint64
_MULTIPLIER = U64(0x9E3779B97F4A7C15 | 1)
_INVERSE = U64(pow(int(_MULTIPLIER), -1, 1 << 64))


@dataclass
class Slice:
    """Rows ``lo`` to ``hi`` of a batch; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``. Nulls are empty."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.hi - self.lo


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, len(column))
        yield Slice(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_byte_codes = mix(np.arange(1, 257, dtype=np.uint64) * U64(0xD1342543DE82EF95))
FOLDED = _byte_codes.copy()
FOLDED[65:91] = _byte_codes[97:123]

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers 0 to n - 1 and those of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each range of ``codes``: equal contents give equal hashes wherever they stand."""
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of a slice: byte ranges, hashes, and ``bounds``: words of text i are bounds[i]:bounds[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the runs without white space (space and 0x09 to 0x0D); a run ends where its text ends."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = (data != 32) & ((data < 9) | (data > 13))
    first, last = np.ones(n, bool), np.ones(n, bool)
    first[1:] = ~solid[:-1]
    last[:-1] = ~solid[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    first[edges] = True
    last[edges[1:] - 1] = True
    return np.flatnonzero(solid & first), np.flatnonzero(solid & last) + 1


def words(part: Slice, codes: np.ndarray = FOLDED) -> Words:
    starts, ends = word_ranges(part.data, part.offsets)
    hashes = range_hashes(codes[part.data], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return Words(starts, ends, hashes, np.searchsorted(starts, part.offsets))


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive words; the last k - 1 starts of a text cross its end, callers leave them out."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, _ = powers(k + 1)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += hashes[i : i + n] * up[i + 1]
    return mix(total + U64(k))


def text_shingles(found: Words, shingles: np.ndarray, i: int, k: int) -> np.ndarray:
    """All shingles of text ``i`` in order; a text of fewer than k words is one shingle, one without words has none."""
    a, b = found.bounds[i], found.bounds[i + 1]
    if b - a >= k:
        return shingles[a : b - k + 1]
    if b == a:
        return np.zeros(0, np.uint64)
    return shingle_hashes(found.hashes[a:b], int(b - a))[:1]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()
