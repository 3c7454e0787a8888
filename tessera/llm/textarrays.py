"""Arrow text columns as numpy byte arrays: words, spans and their hashes.

The operators that run numpy inside ``mapInArrow`` tasks share these helpers.
A record batch is cut into slices of a bounded number of text bytes, so the
temporary arrays (8 bytes per text byte) stay small whatever the batch size;
only a single document larger than the bound makes a larger slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: One random 64-bit value per byte value, drawn from a fixed seed.
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
BYTE_VALUE_2 = np.random.default_rng(71).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of ``batch`` holding at most ``max_bytes`` of
    ``column`` each (a longer text is a slice of its own)."""
    n = batch.num_rows
    if n == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    end = np.cumsum(size.astype(np.int64))
    first = 0
    while first < n:
        before = end[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(end, before + max_bytes, side="right")))
        yield batch.slice(first, last - first)
        first = last


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated UTF-8 bytes of a string column and the row offsets into
    them (null: empty)."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE):
    """Maximal runs of bytes that are no separators, never across rows:
    ``(starts, ends, row)`` arrays."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (edge[:n] | ~before))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        step = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        step[0] = 1
        have = _powers[name] = np.cumprod(step)
    return have


class SpanHash:
    """Polynomial prefix sums over a byte array: the 64-bit hash of any span
    in constant time, equal for equal bytes wherever they stand."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUE):
        self._sum(values[data])

    @classmethod
    def of(cls, values: np.ndarray) -> SpanHash:
        """Over symbols given by their 64-bit values."""
        made = cls.__new__(cls)
        made._sum(values)
        return made

    def _sum(self, values: np.ndarray) -> None:
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _power("up", _BASE, n + 1)[:n], out=self.sums[1:])
        self.down = _power("down", _INVERSE, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as the int64 that Spark's bigint can hold."""
    return x.view(np.int64)
