"""Packed training sequences: token ids laid out by best-fit-decreasing packing.

Each task reads its documents as a stream, tokenises them and packs one bounded window of tokens
after the other, so nothing is shuffled and memory does not grow with the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm.common import documents
from ranktrail.llm.tokens import cuts, default_vocabulary, encoder

PACKED = (
    "sequence_id long, n_tokens int, doc_ids array<long>, pieces array<int>, "
    "starts array<long>, cu_seqlens array<int>, ids binary"
)
_ARROW = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("n_tokens", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("pieces", pa.list_(pa.int32())),
        ("starts", pa.list_(pa.int64())),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("ids", pa.binary()),
    ]
)


class CapacityTree:
    """Segment tree over free capacities: how many open bins leave exactly that much room."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, change: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += change
            node >>= 1

    def tightest(self, size: int) -> int:
        """The smallest capacity of at least the size that some bin has, or -1."""
        count, node = self.count, self.leaves + size
        if count[node]:
            return size
        while node > 1:
            if not node & 1 and count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1


def best_fit_decreasing(sizes: list[int], width: int) -> list[list[int]]:
    """Bins of item numbers; each item goes to the open bin that it leaves the least room in.

    Sizes are 1 to width. Ties go to the lower item number and the latest opened bin.
    """
    tree, open_bins, bins = CapacityTree(width), [[] for _ in range(width + 1)], []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        room = tree.tightest(sizes[item])
        if room < 0:
            place, room = len(bins), width
            bins.append([])
        else:
            place = open_bins[room].pop()
            tree.add(room, -1)
        bins[place].append(item)
        left = room - sizes[item]
        if left:
            open_bins[left].append(place)
            tree.add(left, 1)
    return bins


def pack_documents(
    docs: DataFrame,
    width: int = 2048,
    end_id: int = 0,
    pad_id: int = 0,
    window_tokens: int = 4_000_000,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per packed sequence of at most ``width`` tokens.

    ``ids`` holds width little-endian unsigned 32-bit ids (padded after ``n_tokens``), so the
    column reads as a matrix; ``cu_seqlens`` are the cumulative segment lengths from 0, and the
    position of a token restarts at each of them (``positions``). ``doc_ids``, ``pieces`` and
    ``starts`` name each segment's document, piece number and first token in its document; a
    document longer than the width is cut without loss, only its first piece may be shorter.

    Every document ends with ``end_id``, so an empty or null text is one token, and a null doc_id
    stays null. Repeated rows are packed once each. Columns besides doc_id and text are ignored.
    An empty table gives no rows. Sequence numbers depend on how the input is split into tasks;
    each is unique within a result.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        base, made = TaskContext.get().partitionId() << 32, 0
        keys, parts, held = [], [], 0

        def flush():
            nonlocal made
            rows = []
            for bin_ in best_fit_decreasing([len(p) for p in parts], width):
                segments = [parts[i] for i in bin_]
                ids = np.full(width, pad_id, "<u4")
                flat = np.concatenate(segments)
                ids[: len(flat)] = flat
                ends = np.cumsum([0, *map(len, segments)]).tolist()
                doc_ids, pieces, starts = map(list, zip(*(keys[i] for i in bin_), strict=True))
                rows.append((base + made, len(flat), doc_ids, pieces, starts, ends, ids.tobytes()))
                made += 1
                if len(rows) == 500:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.append(encode(text or ""), np.uint32(end_id))
                for piece, (start, length) in enumerate(cuts(len(ids), width)):
                    keys.append((doc_id, piece, start))
                    parts.append(ids[start : start + length])
                held += len(ids)
                if held >= window_tokens:
                    yield from flush()
                    keys, parts, held = [], [], 0
        if parts:
            yield from flush()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PACKED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)],
        schema=_ARROW,
    )


def id_matrix(rows: list[bytes], width: int) -> np.ndarray:
    """The stored ids of some sequences as a matrix."""
    return np.frombuffer(b"".join(rows), "<u4").reshape(-1, width)


def positions(cu_seqlens: list[int]) -> np.ndarray:
    """Position of every token, counted anew from each segment's start."""
    edges = np.asarray(cu_seqlens)
    return np.arange(edges[-1]) - np.repeat(edges[:-1], np.diff(edges))


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the matrices with their lengths and resets; one file per task, any store."""
    resets = F.slice("cu_seqlens", 1, F.size("cu_seqlens") - 1)
    packed.withColumn("position_resets", resets).write.parquet(path)


def op1_pack_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
