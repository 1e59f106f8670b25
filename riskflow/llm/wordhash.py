"""Words and shingles of many texts at once, as 64-bit hashes computed over the UTF-8 bytes of an Arrow column.

Texts are taken in slices of bounded size, one long text at a time, so memory does not depend on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Everything of ASCII but letters and digits.
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    plain = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    folded = plain.copy()
    folded[65:91] = plain[97:123]
    return plain, folded


PLAIN, FOLDED = _tables()
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1; kept for slices of the usual size."""
    kept = _powers.get(base)
    if kept is not None and len(kept) >= n:
        return kept[:n]
    size = max(n, SLICE_BYTES + 1 if n <= SLICE_BYTES + 1 else n)
    made = np.full(size, base, np.uint64)
    made[0] = 1
    made = np.multiply.accumulate(made)
    if size == SLICE_BYTES + 1:
        _powers[base] = made
    return made[:n]


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "") if column.null_count else column
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, bounds) of runs of rows of up to ``most`` bytes, at least one row each."""
    data, bounds = string_bytes(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        after = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1)
        yield first, after, data[bounds[first] : bounds[after]], bounds[first : after + 1] - bounds[first]
        first = after


@dataclass
class Words:
    """starts, ends: byte places; hashes; bounds: where each text's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def words(data: np.ndarray, bounds: np.ndarray, fold: bool = True, blank: np.ndarray = BLANK) -> Words:
    """Runs of bytes that are not ``blank``, within each text; ``fold`` reads A-Z as a-z."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64))
    letter = ~blank[data]
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    first[edges] = letter[edges]
    last[edges - 1] = letter[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((FOLDED if fold else PLAIN)[data] * _power(_BASE, n), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts]
    hashes = mix(raw + (ends - starts).astype(np.uint64))
    return Words(starts, ends, hashes, np.searchsorted(starts, bounds))


def chain(parts: list[np.ndarray], salt: int) -> np.ndarray:
    """Hash of sequences given position by position."""
    out = np.full(len(parts[0]), salt, np.uint64)
    for p in parts:
        out = mix(out * _M2 + p)
    return out


def shingle_sets(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of ``k`` words of each text, one after the other, and the texts' bounds.

    A text of fewer words has one shingle, the whole; a text without words has none.
    """
    h, b = found.hashes, found.bounds
    n = len(h) - k + 1
    every = chain([h[j : j + n] for j in range(k)], k) if n > 0 else np.zeros(0, np.uint64)
    sets, sizes = [], np.zeros(len(b), np.int64)
    for i in range(len(b) - 1):
        lo, hi = int(b[i]), int(b[i + 1])
        if hi - lo >= k:
            own = np.unique(every[lo : hi - k + 1])
        elif hi > lo:
            own = chain([h[j : j + 1] for j in range(lo, hi)], hi - lo)
        else:
            continue
        sets.append(own)
        sizes[i + 1] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.cumsum(sizes)
