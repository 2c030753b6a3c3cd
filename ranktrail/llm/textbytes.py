"""Texts of Arrow batches as arrays of bytes, and polynomial hashes of their parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 250_000  # an array of a number per byte takes 2 MB
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2 ** 64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)
_powers: dict[bool, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE to the powers 0 to n - 1, or those of its inverse."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        factor = pow(int(BASE), -1, 1 << 64) if inverse else int(BASE)
        steps = np.full(max(n, CHUNK_BYTES + 1), factor, np.uint64)
        steps[0] = 1
        have = _powers[inverse] = np.multiply.accumulate(steps)
    return have[:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Sums of values[j] * BASE ** j for j < i, for i from 0 to their number."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=sums[1:])
    return sums


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values in [start, end), alike wherever they stand."""
    return (prefix[end] - prefix[start]) * powers(len(prefix), inverse=True)[start]


def byte_chunks(
    column: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``limit`` bytes.

    Nulls are empty. A longer text is a chunk of its own.
    """
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        high = min(high, len(column))
        yield low, high, raw[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high
