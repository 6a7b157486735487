"""Texts of an Arrow batch as numpy byte arrays: bounded slices, words, rolling hashes.

All hashes are fixed functions of the bytes, so that any executor computes the same ones again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Texts are worked on in runs of rows of about so many bytes; a longer text forms a run of its own.
SLICE_BYTES = 2 << 20

_rng = np.random.default_rng(20240601)
#: One odd multiplier and one random value per byte.
_BYTE_VALUES = _rng.integers(0, 2**64, 256, dtype=np.uint64)
R = np.uint64(0x9E3779B97F4A7C15)
R_INVERSE = np.uint64(pow(int(R), -1, 2**64))
_powers = {}

#: Bytes between words `[^\x20\x09-\x0D]+`.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


class Texts(NamedTuple):
    first: int           # row of the batch at which the run begins
    data: np.ndarray     # the bytes of all its texts
    offsets: np.ndarray  # where each text begins, and the end

    def __len__(self):
        return len(self.offsets) - 1

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.offsets])


def texts_of(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts (null: empty) of a column as runs of rows of bounded size."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
        stop = min(stop, n)
        yield Texts(row, data[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row])
        row = stop


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of True bytes; a run never crosses from one text into the next."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(inside))]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def counts_by_text(begins: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the (ascending) positions lie in each text."""
    return np.diff(np.searchsorted(begins, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... of at least ``n`` numbers, modulo 2**64; short ones are kept."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        size = max(n, 1 << 16, min(2 * len(known) if known is not None else 0, SLICE_BYTES + 1))
        known = np.full(size, base)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if size <= 2 * SLICE_BYTES:
            _powers[int(base)] = known
    return known


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums from which :func:`span_hashes` takes the hash of any span."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(R, len(data))[:len(data)], dtype=np.uint64, out=total[1:])
    return total


def span_hashes(total: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, wherever it stands."""
    inverse = powers(R_INVERSE, len(total))
    return mix((total[ends] - total[begins]) * inverse[begins] + (ends - begins).astype(np.uint64))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` word hashes in a row, for each place where so many follow."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= R
        out += words[k:k + n]
    return mix(out)
