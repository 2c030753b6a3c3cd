"""Hierarchical best-fit packing: local rounds, whose underfull bins are the next round's items.

Round 0 spreads the items over groups of bounded size and packs each group best-fit. Bins that
are nearly full are final. The others become items of the next round, in fewer groups, until one
group holds them all or a round merges hardly any. Placement is composed backwards over rounds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm.common import documents, stored
from ranktrail.llm.tokens import cuts, default_vocabulary, encoder

WIDTH = 2048
GROUP_ITEMS = 50_000  # items that one task packs at once
NEARLY_FULL = 8  # tokens a final bin may leave free
TEXTS_AT_ONCE = 500  # texts of a batch that a task holds as Python strings

_PIECES = pa.schema(
    [
        ("item", pa.int64()),
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
_PIECES_DDL = "item long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED_DDL = "item long, size long, bin long, offset long, used long"


def token_pieces(
    docs: DataFrame, width: int = WIDTH, end_id: int = 0, vocabulary: str | None = None
) -> DataFrame:
    """The pieces of every document with the checksum of their ids; ids stay in the task.

    An empty or null text is one piece that holds the end id alone.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        item = TaskContext.get().partitionId() << 36
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for low in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.slice(low, TEXTS_AT_ONCE)
                rows = []
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    data = encode(text or "").astype("<u4").tobytes() + end
                    for piece, (start, n) in enumerate(cuts(len(data) // 4, width)):
                        crc = zlib.crc32(data[4 * start : 4 * (start + n)])
                        rows.append((item, doc_id, piece, start, n, crc))
                        item += 1
                columns = zip(zip(*rows, strict=True), _PIECES, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in columns], schema=_PIECES
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES_DDL)


def best_fit(sizes: list[int], width: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, largest items first, each into the tightest open bin."""
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    by_room: list[list[int]] = [[] for _ in range(width + 1)]
    rooms, made = 0, 0  # bit r of rooms: some bin has r free
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, place = width, made
            made += 1
        bins[i], offsets[i] = place, width - room
        left = room - size
        by_room[left].append(place)
        if left:
            rooms |= 1 << left
    return bins, offsets


def _round(items: DataFrame, groups: int, number: int, width: int) -> DataFrame:
    """Pack each group of (item, size); bins are numbered by round, group and place."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "item"], ascending=[False, True], ignore_index=True)
        bins, offsets = best_fit(group["size"].tolist(), width)
        base = -((number + 1) << 56) - (int(key[0]) << 24)
        out = pd.DataFrame({"item": group["item"], "size": group["size"], "offset": offsets})
        out["bin"] = [base - b for b in bins]
        out["used"] = out.groupby("bin")["size"].transform("sum")
        return out[["item", "size", "bin", "offset", "used"]]

    group = F.pmod(F.xxhash64("item", F.lit(number)), F.lit(groups)).cast("int")
    return (
        items.select("item", "size", group.alias("g")).groupBy("g").applyInPandas(pack, _PLACED_DDL)
    )


def place_items(
    items: DataFrame,
    width: int = WIDTH,
    group_items: int = GROUP_ITEMS,
    nearly_full: int = NEARLY_FULL,
) -> DataFrame:
    """Place rows of (item, size), size 1 to width, into bins: (item, bin, offset).

    Items as large as a bin are bins of their own. Items are unique negative-free longs. Every
    round leaves fewer items; the rounds end when a single group has packed all that was left, or
    when a round in several groups has merged less than a tenth of them.
    """
    full = items.filter(F.col("size") >= width - nearly_full)
    left = items.filter(F.col("size") < width - nearly_full).select("item", "size")
    n = left.count()
    rounds = []
    while n:
        groups = -(-n // group_items)
        placed = stored(_round(left, groups, len(rounds), width), f"packing-{len(rounds)}")
        rounds.append(placed)
        underfull = placed.filter(F.col("used") < width - nearly_full)
        left = underfull.select(F.col("bin").alias("item"), F.col("used").alias("size")).distinct()
        before, n = n, left.count()
        if groups == 1 or n > 0.9 * before:
            break
    alone = full.select("item", F.col("item").alias("bin"), F.lit(0).cast("long").alias("offset"))
    if not rounds:
        return alone
    placed = rounds[0].select("item", "bin", "offset")
    for later in rounds[1:]:
        moved = later.select(
            F.col("item").alias("bin"), F.col("bin").alias("into"), F.col("offset").alias("shift")
        )
        placed = placed.join(moved, "bin", "left").select(
            "item",
            F.coalesce("into", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
    return placed.unionByName(alone)


def pack_best_fit(docs: DataFrame, width: int = WIDTH, vocabulary: str | None = None) -> DataFrame:
    """Place all pieces of all documents: one row per piece.

    Null or empty texts take one token; a null doc_id stays null; repeated rows are packed each;
    other columns are ignored; an empty table gives no rows. Only documents above the width are
    cut, and only their first piece may be shorter than it.
    """
    pieces = stored(token_pieces(docs, width, vocabulary=vocabulary), "pieces")
    placed = place_items(pieces.select("item", F.col("length").alias("size")), width)
    return pieces.join(placed, "item").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.col("bin").alias("sequence_id"),
        "offset",
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(documents(spark, sf_dir))
