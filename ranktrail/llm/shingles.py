"""Hashed sets of five-word shingles, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ranktrail.llm.textbytes import BYTE_VALUES, byte_chunks, mixed, prefix_hashes, span_hashes

WORDS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUES = BYTE_VALUES[_LOWER]
_FACTORS = mixed(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, bounds): row first + i has the sorted set hashes[bounds[i]:bounds[i+1]].

    Words are runs of non-space bytes with A-Z lowered; a text of fewer than five words is one
    shingle, a text without words has none.
    """
    for first, end, data, offsets in byte_chunks(column):
        space = _SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets[:-1]] = True  # words end with their text
        inside = ~space
        starts = inside.copy()
        starts[1:] &= space[:-1] | edge[1:-1]
        ends = inside.copy()
        ends[:-1] &= space[1:] | edge[1:-1]
        start, stop = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        prefix = prefix_hashes(_VALUES[data])
        words = mixed(span_hashes(prefix, start, stop))
        bound = np.searchsorted(start, offsets)  # words of each row
        n = np.diff(bound)
        # a shingle starts at every word but the last four of a row
        sums = np.zeros(len(words), np.uint64)
        reach = len(words) - WORDS + 1
        if reach > 0:
            for k in range(WORDS):
                sums[:reach] += words[k : k + reach] * _FACTORS[k]
        hashes = mixed(sums)
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(words)) - bound[row]
        take = place <= n[row] - WORDS
        for r in np.flatnonzero((n > 0) & (n < WORDS)):
            few = words[bound[r] : bound[r + 1]] * _FACTORS[: n[r]]
            hashes[bound[r]] = mixed(few.sum(dtype=np.uint64)[None] + np.uint64(n[r]))[0]
            take[bound[r]] = True
        hashes, row = hashes[take], row[take]
        edges = np.searchsorted(row, np.arange(len(n) + 1))
        for r in range(len(n)):
            hashes[edges[r] : edges[r + 1]].sort()
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        hashes, row = hashes[new], row[new]
        yield first, hashes, np.searchsorted(row, np.arange(len(n) + 1))
