"""Removal of long repeats with run-compressed Burrows-Wheeler indexes.

Every window of ``length`` bytes elects an anchor: the 64-byte string of least hash in it. Equal
windows elect equal anchors at equal places, so only texts around a common anchor can share a
window. The stretch of windows that elect an anchor is its context. Equal contexts are counted and
kept once; the others that share an anchor meet in an index of bounded size.

There the rows of the sorted suffixes fall into runs of equal preceding bytes, and the index keeps the
runs, the suffixes at their ends and the matches measured there. Inside a run, the match of a suffix with its
neighbour is that of the text position before it less one byte, so matching statistics
stream from the run ends over the text, and long ones are marked. Anchors with too many contexts for one index are decided by counting the hashes
of their windows, which spreads over any number of tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm.common import documents, stored, unpacked, whole_rows, with_listed
from ranktrail.llm.textbytes import (
    BYTE_VALUES,
    byte_chunks,
    mixed,
    powers,
    prefix_hashes,
    span_hashes,
)

LENGTH = 400
ANCHOR = 64  # bytes of an anchor
INDEX_BYTES = 1_000_000  # context bytes an index is meant to hold
MOST_CONTEXTS = 1_000  # distinct contexts of an anchor that one index takes
FIRST_SORT = 7  # bytes compared in the first sort of suffixes; then twice as many each time

_ANCHORS = "doc_id long, th long, fp long, ctx long, lo int, p int, hi int"
_CONTEXTS = "fp long, ctx long, lo int, p int, hi int, doc_id long, th long, data binary"


def _least_in_window(keys: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        keys = np.minimum(keys[:-reach], keys[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray] | None:
    """Anchors of all windows in the texts of a chunk; places count from the chunk's start."""
    n = len(data)
    if n < length:
        return None
    prefix = prefix_hashes(BYTE_VALUES[data])
    grams = mixed((prefix[ANCHOR:] - prefix[:-ANCHOR]) * powers(n - ANCHOR + 1, inverse=True))
    places = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << max(22, n.bit_length())) - 1)
    least = _least_in_window((grams & ~low) | places, length - ANCHOR + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.flatnonzero(row[: n - length + 1] == row[length - 1 :])
    if not len(start):
        return None
    at = (least[start] & low).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    lo, p = start[first], at[first]
    hi = start[np.append(first[1:], len(start)) - 1] + length
    frame = (p - lo).astype(np.uint64) * np.uint64(1 << 32) + (hi - p).astype(np.uint64)
    ctx = mixed(mixed(span_hashes(prefix, lo, hi)) + mixed(frame))
    return {"row": row[lo], "fp": grams[p], "ctx": ctx, "lo": lo, "p": p, "hi": hi}


def _find_anchors(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in byte_chunks(batch["text"]):
                found = anchors(data, offsets, length)
                if found is None:
                    continue
                row = found["row"]
                shift = offsets[row]
                rows = pa.array(row + first)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_id"].take(rows),
                        "th": batch["th"].take(rows),
                        "fp": found["fp"].view(np.int64),
                        "ctx": found["ctx"].view(np.int64),
                    }
                    | {k: (found[k] - shift).astype(np.int32) for k in ("lo", "p", "hi")}
                )

    return find


class RunIndex:
    """Run-length Burrows-Wheeler transform of some texts, with the suffixes at the ends of its runs.

    What stays of the sorted suffixes is a symbol, a length and two text places for every run: those of
    its first and its last suffix, and how far the first one matches the last one of the run before. So
    the index grows with the number of runs, which repetition does not raise.
    """

    def __init__(self, texts: list[np.ndarray], length: int):
        self.length = length
        sizes = np.array([len(t) + 1 for t in texts])
        self.start = np.cumsum(sizes) - sizes
        symbols = np.zeros(int(sizes.sum()), np.uint16)  # 0 ends a text and is unlike any other 0
        for at, text in zip(self.start, texts, strict=True):
            symbols[at : at + len(text)] = text
            symbols[at : at + len(text)] += 1
        self.places = len(symbols)
        order = _suffix_order(symbols)
        before = np.where(order > 0, symbols[order - 1], 0)
        new = np.ones(len(order), bool)  # a text's beginning is a run of its own
        new[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        rows = np.flatnonzero(new)
        self.symbol = before[rows]
        self.size = np.diff(np.append(rows, len(order)))
        self.head, self.tail = order[rows], order[rows + self.size - 1]
        self.match = _common(symbols, self.tail[:-1], self.head[1:])

    def matching_statistics(self) -> np.ndarray:
        """For every place the longest match of its suffix with any other.

        A suffix and its neighbour inside a run match one byte less than the suffixes one place before
        them, so the statistics stream from the samples at run ends over the text.
        """
        reach = np.zeros(self.places, np.int64)
        np.maximum.at(reach, self.head[1:], self.head[1:] + self.match)
        np.maximum.at(reach, self.tail[:-1], self.tail[:-1] + self.match)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(self.places), 0)

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of matches of at least ``length`` that cover all repeated windows."""
        found = self.matching_statistics()
        start = np.flatnonzero(found >= self.length)
        return start, found[start]


def _suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order. A 0 ends a suffix; equal ones are in order of place."""
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # bytes up to the end
    padded = np.append(symbols, np.zeros(FIRST_SORT, np.uint16)).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(FIRST_SORT):
        key = (key << np.uint64(9)) | np.where(left > i, padded[i : i + n], 0).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    alone = left[order] < FIRST_SORT
    new |= alone
    new[1:] |= alone[:-1]
    place = np.arange(n, dtype=np.int32)
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    reach = FIRST_SORT
    while True:
        # suffixes alone in their rank have their place; the others are sorted again
        open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(open_):
            return order
        items = order[open_]
        pair = rank[items].astype(np.int64) * n + rank[items + reach]  # such a suffix is as long
        by = np.argsort(pair, kind="stable")
        items, pair = items[by], pair[by]
        order[open_] = items
        fresh = np.ones(len(items), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        new[open_] = fresh
        rank[items] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))]
        reach *= 2


def _common(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 32) -> np.ndarray:
    """Common bytes of pairs of suffixes, compared block by block; few blocks, as only run ends are."""
    done = np.zeros(len(a), np.int64)
    padded = np.append(symbols, np.zeros(block, symbols.dtype))
    going = np.arange(len(a))
    steps = np.arange(block)
    while len(going):
        following = []
        for low in range(0, len(going), 50_000):
            part = going[low : low + 50_000]
            x = padded[(a[part] + done[part])[:, None] + steps]
            y = padded[(b[part] + done[part])[:, None] + steps]
            other = (x != y) | (x == 0)
            whole = ~other.any(1)
            done[part] += np.where(whole, block, other.argmax(1))
            following.append(part[whole])
        going = np.concatenate(following)
    return done


def united(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans as maximal ones."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.append(True, start[1:] > end[:-1])
    return start[first], end[np.append(first[1:], True)]


def _index_group(length: int):
    def mark(table: pa.Table) -> pa.Table:
        """Marked spans of every context, counted from its anchor."""
        rows = table.combine_chunks().to_pydict()
        n = len(rows["fp"])
        doc = [(d is None, d or 0, t) for d, t in zip(rows["doc_id"], rows["th"], strict=True)]
        order = sorted(range(n), key=lambda i: (doc[i], rows["lo"][i], rows["hi"][i]))
        # contexts of a text that overlap become one stretch, so no place counts twice
        texts, stretch, shift = [], [0] * n, []
        parts: list[np.ndarray] = []
        end, last = 0, None
        for i in order:
            lo, hi = rows["lo"][i], rows["hi"][i]
            data = np.frombuffer(rows["data"][i], np.uint8)
            if doc[i] != last or lo > end:
                if parts:
                    texts.append(np.concatenate(parts))
                parts, last, end = [], doc[i], lo
                shift.append(lo)
            if hi > end:
                parts.append(data[end - lo :])
                end = hi
            stretch[i] = len(shift) - 1
        texts.append(np.concatenate(parts))
        index = RunIndex(texts, length)
        start, size = index.repeats()
        start, end_ = united(start, start + size)
        fps, ctxs, spans = [], [], []
        for i in range(n):
            at = index.start[stretch[i]] - shift[stretch[i]]
            lo, hi = rows["lo"][i] + at, rows["hi"][i] + at
            first, stop = np.searchsorted(end_, lo, "right"), np.searchsorted(start, hi)
            cut = [
                (max(int(start[j]), lo) - at - rows["p"][i], min(int(end_[j]), hi) - at - rows["p"][i])
                for j in range(first, stop)
            ]
            if cut:
                fps.append(rows["fp"][i])
                ctxs.append(rows["ctx"][i])
                spans.append([x for pair in cut for x in pair])
        return pa.table(
            {
                "fp": pa.array(fps, pa.int64()),
                "ctx": pa.array(ctxs, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.int32())),
            }
        )

    return mark


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("fp", "ctx", "lo", "p", "hi")
    for batch in batches:
        for r in range(len(batch)):
            text = (batch["text"][r].as_py() or "").encode()
            wanted = batch["wanted"][r].values.flatten()
            part = dict(zip(names, wanted, strict=True))
            data = [text[a:b] for a, b in zip(part["lo"].to_pylist(), part["hi"].to_pylist(), strict=True)]
            n = len(data)
            yield pa.RecordBatch.from_pydict(
                part
                | {
                    "doc_id": batch["doc_id"].take(pa.array([r] * n)),
                    "th": batch["th"].take(pa.array([r] * n)),
                    "data": pa.array(data, pa.binary()),
                }
            )


def _window_hashes(length: int):
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # cut in the same call, as a second one would hold a Python worker more for each task
        for batch in _cut_contexts(batches):
            columns = (batch[c] for c in ("fp", "ctx", "lo", "p", "hi", "data"))
            for row in zip(*(c.to_pylist() for c in columns), strict=True):
                fp, ctx, lo, p, hi, data = row
                prefix = prefix_hashes(BYTE_VALUES[np.frombuffer(data, np.uint8)])
                n = hi - lo - length + 1
                start = np.arange(n)
                yield pa.RecordBatch.from_pydict(
                    {
                        "fp": np.full(n, fp),
                        "ctx": np.full(n, ctx),
                        "at": (start + lo - p).astype(np.int32),
                        "wh": mixed(span_hashes(prefix, start, start + length)).view(np.int64),
                    }
                )

    return hashes


def _parted(docs: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may have a partner of the same doc_id in ``listed``, and those that have none and stay unshuffled."""
    ids = listed.select(F.col("doc_id").alias("t_")).filter(F.col("t_").isNotNull()).distinct()
    marked = with_listed(docs, ids)
    near = F.col("t_") | F.col("doc_id").isNull()
    return marked.filter(near).drop("t_"), marked.filter(~near).drop("t_")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, th, spans): per text the spans to remove, as flat pairs of start and end.

    ``th`` is the hash of the text, which tells apart texts that share a doc_id. Spans may
    overlap. Texts without any are left out.
    """
    known = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    found = stored(known.mapInArrow(_find_anchors(length), _ANCHORS), "anchors")
    fields = ("doc_id", "th", "lo", "p", "hi")
    # most anchors stand in one place only; nothing but their hashes is shuffled to find that out
    met = found.groupBy("fp").agg(F.count("*").alias("places")).filter(F.col("places") > 1).select("fp")
    # a join of two plain tables can split an anchor with very many contexts
    found = stored(found.join(stored(met, "shared-anchors").hint("merge"), "fp", "semi"), "shared-places")
    contexts = found.groupBy("fp", "ctx").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in fields]
    )
    contexts = stored(contexts, "contexts")
    kinds = stored(contexts.groupBy("fp").agg(F.count("*").alias("kinds")), "kinds")
    shared = stored(contexts.join(kinds, "fp"), "shared-contexts")
    whole = shared.filter(F.col("n") > 1).select(
        "fp", "ctx", F.array(F.col("lo") - F.col("p"), F.col("hi") - F.col("p")).alias("spans")
    )
    apart = shared.filter(F.col("kinds") > 1)
    wanted = apart.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("fp", "ctx", "lo", "p", "hi", "kinds")).alias("wanted")
    )
    wanted = wanted.withColumnsRenamed({"doc_id": "d_", "th": "t_"})
    here = F.col("doc_id").eqNullSafe(F.col("d_")) & F.col("th").eqNullSafe(F.col("t_"))
    texts, _ = _parted(known, apart)
    few = F.filter("wanted", lambda w: w["kinds"] <= MOST_CONTEXTS)
    many = F.filter("wanted", lambda w: w["kinds"] > MOST_CONTEXTS)

    def rows_with(chosen):
        names = ["fp", "ctx", "lo", "p", "hi"]
        plain = F.transform(chosen, lambda w: F.struct(*[w[c].alias(c) for c in names]))
        chosen = wanted.withColumn("wanted", plain).filter(F.size("wanted") > 0)
        return texts.join(chosen.hint("merge"), here).select("doc_id", "th", "text", "wanted")

    sizes = apart.agg(
        F.sum(F.when(F.col("kinds") <= MOST_CONTEXTS, F.col("hi") - F.col("lo"))),
        F.max("kinds"),
    ).first()
    marks = whole
    if sizes[0]:
        group = F.pmod("fp", F.lit(-(-sizes[0] // INDEX_BYTES))).alias("g")
        cut = rows_with(few).mapInArrow(_cut_contexts, _CONTEXTS)
        indexed = cut.select("*", group).groupBy("g").applyInArrow(
            _index_group(length), "fp long, ctx long, spans array<int>"
        )
        marks = marks.unionByName(indexed)
    if (sizes[1] or 0) > MOST_CONTEXTS:
        windows = rows_with(many).mapInArrow(_window_hashes(length), "fp long, ctx long, at int, wh long")
        windows = stored(windows, "windows")
        twice = windows.groupBy("fp", "wh").agg(F.count("*").alias("k")).filter(F.col("k") > 1)
        twice = windows.join(twice, ["fp", "wh"], "semi").groupBy("fp", "ctx")
        spans = F.flatten(F.collect_list(F.array(F.col("at"), F.col("at") + length)))
        marks = marks.unionByName(twice.agg(spans.alias("spans")))
    moved = F.transform("spans", lambda x: x + F.col("p"))
    return (
        found.join(stored(marks, "marks"), ["fp", "ctx"])
        .select("doc_id", "th", moved.alias("spans"))
        .groupBy("doc_id", "th")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def _without(text: str | None, spans: list[int] | None) -> tuple[bytes, int, int, int]:
    data = (text or "").encode()
    flat = np.asarray([] if spans is None else spans, np.int64)
    start, end = united(flat[::2], flat[1::2])
    kept, at = [], 0
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    rest = b"".join(kept)
    return rest, len(data), len(data) - len(rest), len(start)


def _marked(docs: DataFrame, length: int) -> DataFrame:
    """Whole rows with the spans to remove from their texts, null without any."""
    spans = stored(repeated_spans(docs, length), "spans")
    rows = docs.select(whole_rows(docs), F.col("doc_id").cast("long"))
    hit, missed = _parted(rows, spans)
    spans = spans.withColumnsRenamed({"doc_id": "d_", "th": "t_"})
    text = F.col("row_.text")
    here = F.col("row_.doc_id").cast("long").eqNullSafe(F.col("d_"))
    here &= F.xxhash64(text).eqNullSafe(F.col("t_"))
    hit = hit.join(spans.hint("merge"), here, "left").select("row_", "spans")
    return hit.unionByName(missed.select("row_", F.lit(None).cast("array<int>").alias("spans")))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """What stays, and its digest: doc_id, n_bytes, n_removed, n_spans, kept_sha256, text per document.

    ``text`` is what is left, without what a cut leaves of a character of several bytes; null if it was null.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in any
    text, repeated rows included. Null text is empty; a null doc_id stays null. Other columns are
    ignored. An empty table gives no rows.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch["text"].to_pylist(), batch["spans"].to_pylist()
            rows = [_without(t, s) for t, s in zip(texts, spans, strict=True)]
            left = [None if t is None else r[0].decode("utf-8", "ignore") for t, r in zip(texts, rows, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n_bytes": pa.array([r[1] for r in rows], pa.int64()),
                    "n_removed": pa.array([r[2] for r in rows], pa.int64()),
                    "n_spans": pa.array([r[3] for r in rows], pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows], pa.string()),
                    "text": pa.array(left, pa.string()),
                }
            )

    columns = docs.select(F.col("doc_id").cast("long"), "text")
    return (
        _marked(columns, length)
        .select("row_.doc_id", "row_.text", "spans")
        .mapInArrow(
            digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
        )
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeats cut out of their texts and ``n_chars``, if any, counted again.

    A cut may split a character of several bytes; what is left of it goes too. Untouched rows
    stay as they are, null texts among them.
    """

    @F.pandas_udf("string")
    def rest(text: pd.Series, spans: pd.Series) -> pd.Series:
        pairs = zip(text, spans, strict=True)
        return pd.Series([_without(t, s)[0].decode("utf-8", "ignore") for t, s in pairs], dtype=object)

    marked = _marked(docs, length)
    whole = marked.filter(F.col("spans").isNull()).select(unpacked(docs.columns))
    cut = marked.filter(F.col("spans").isNotNull())
    cut = cut.select("row_", rest("row_.text", "spans").alias("text_"))
    columns = {c: F.col("row_").getField(c) for c in docs.columns} | {"text": F.col("text_")}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("text_").cast(docs.schema["n_chars"].dataType)
    return whole.unionByName(cut.select(*[c.alias(name) for name, c in columns.items()]))


def op10_run_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))
