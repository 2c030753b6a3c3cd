"""Spelling variants of the corpus vocabulary, by search schemes over bidirectional FM-indexes.

Two words one edit apart share the first half of either of them, or the second half, exactly. So
the vocabulary is dealt twice, by the first three letters and by the last three (a half has three at
least), and words that share neither never meet. Each group of words becomes one delimited text
with a bidirectional FM-index: suffix-rank intervals of the text and of its mirror image, kept in step, so
that a match can grow to either side. A scheme matches one half of a query word exactly, turns
round, and extends over the other half with one insertion, deletion or replacement.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm.common import documents, stored

LEAST_LENGTH = 6  # so that each half of a word has KEY letters
LEAST_COUNT = 5
RATIO = 5  # a form is at least so many times as frequent
NOISE = 199  # one of so many runs, by hash, loses a letter
KEY = 3
INDEX_SYMBOLS = 500_000  # letters and delimiters an index is meant to hold
SEARCHED = 20_000  # words searched at once
FLUSH = 200_000  # distinct words a task counts before it hands them on

_LETTERS = "a-zA-ZÀ-ÿ"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STRIDE = 64  # rows between two stored rows of counts
_END, _MARK = 0, 1  # symbols: end of the text, delimiter of words


def _altered(doc_id: int | None, run: str, noise: int) -> str:
    if doc_id is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count_words(least: int, noise: int):
    runs = re.compile(f"[{_LETTERS}]{{{least},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def batch_of() -> pa.RecordBatch:
            columns = {"word": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                if not text.is_valid:
                    continue
                lowered = text.as_py().encode().translate(_LOWER).decode()
                for run, n in Counter(runs.findall(lowered)).items():
                    word = _altered(doc_id, run, noise)
                    if len(word) >= least:
                        found[word] += n
                if len(found) >= FLUSH:
                    yield batch_of()
                    found.clear()
        yield batch_of()

    return count


def vocabulary(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int = NOISE
) -> DataFrame:
    """(word, n): the words that are long and frequent enough, with their occurrences in all texts."""
    known = docs.select(F.col("doc_id").cast("long"), "text")
    counts = known.mapInArrow(_count_words(least_length, noise), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a text that ends in its only least symbol, in order."""
    n = len(text)
    reach = 7  # symbols of at most 9 bits in the first key
    padded = np.append(text, np.zeros(reach, text.dtype)).astype(np.int64)
    key = np.zeros(n, np.int64)
    for i in range(reach):
        key = key << 9 | padded[i : i + n]
    while True:
        order = np.argsort(key, kind="stable")
        new = np.ones(n, bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        if new.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        behind = np.zeros(n, np.int64)
        behind[: n - reach] = rank[reach:]
        key = rank * (n + 1) + behind
        reach *= 2


class _Side:
    """Burrows-Wheeler transform of a text, with counts at every _STRIDE-th row."""

    def __init__(self, text: np.ndarray, size: int):
        order = _suffix_order(text)
        self.order = order
        last = text[order - 1].astype(np.uint8)  # the end symbol where a suffix is the whole text
        self.last = last
        n = len(text)
        rows = -(-n // _STRIDE) + 1
        padded = np.full(rows * _STRIDE, 255, np.uint8)
        padded[:n] = last
        self.blocks = padded.reshape(rows, _STRIDE)
        cell = np.arange(n) // _STRIDE * size + last
        counts = np.bincount(cell, minlength=rows * size).reshape(rows, size)
        before = np.cumsum(counts, 0) - counts
        self.equal = before.astype(np.int32)
        self.less = (np.cumsum(before, 1) - before).astype(np.int32)
        totals = np.bincount(text, minlength=size)
        self.first = np.cumsum(totals) - totals  # first row of the suffixes that begin with a symbol

    def counts(self, symbol: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often the symbol, and how often lesser ones, stand before a row of the transform."""
        block = row // _STRIDE
        cells = self.blocks[block]
        inside = np.arange(_STRIDE) < (row % _STRIDE)[:, None]
        wanted = symbol.astype(np.uint8)[:, None]
        equal = self.equal[block, symbol] + ((cells == wanted) & inside).sum(1)
        less = self.less[block, symbol] + ((cells < wanted) & inside).sum(1)
        return equal, less


class BidirectionalIndex:
    """FM-index of a delimited text and of its mirror image with intervals that move in step.

    A state is a pair of row intervals, (low, high) in the text's suffix order and in the mirror's,
    of one string; ``extend`` puts a symbol before it (``left``) or behind it.
    """

    def __init__(self, words: list[np.ndarray], size: int):
        """``words``: arrays of symbols from 2 to ``size`` - 1."""
        mark = np.array([_MARK], np.int64)
        parts = [mark]
        for word in words:
            parts += [word, mark]
        body = np.concatenate(parts)
        end = np.array([_END], np.int64)
        text = np.concatenate([body, end])
        self.size = size
        self.sides = _Side(text, size), _Side(np.concatenate([body[::-1], end]), size)
        # the word behind every delimiter, by row of the suffixes that begin with one
        self.mark = int(self.sides[0].first[_MARK])
        starts = self.sides[0].order[self.mark : self.mark + len(words) + 1]
        self.word = np.searchsorted(np.flatnonzero(text == _MARK), starts)

    def whole(self, count: int) -> np.ndarray:
        """States of the empty string: rows of low, high, low and high in the mirror."""
        n = len(self.sides[0].last)
        return np.tile(np.array([0, n, 0, n], np.int64), (count, 1))

    def extend(self, states: np.ndarray, symbol: np.ndarray, left: bool) -> np.ndarray:
        side, a, b = (self.sides[0], 0, 2) if left else (self.sides[1], 2, 0)
        equal_low, less_low = side.counts(symbol, states[:, a])
        equal_high, less_high = side.counts(symbol, states[:, a + 1])
        out = np.empty_like(states)
        out[:, a] = side.first[symbol] + equal_low
        out[:, a + 1] = side.first[symbol] + equal_high
        out[:, b] = states[:, b] + less_high - less_low
        out[:, b + 1] = out[:, b] + equal_high - equal_low
        return out

    def choices(self, states: np.ndarray, left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number of the state, letter) for the letters that may stand next to each state's string."""
        side, a = (self.sides[0], 0) if left else (self.sides[1], 2)
        low, width = states[:, a], states[:, a + 1] - states[:, a]
        few = np.flatnonzero(width <= 2 * self.size)
        many = np.flatnonzero(width > 2 * self.size)
        which = np.repeat(few, width[few])
        within = np.arange(len(which)) - np.repeat(np.cumsum(width[few]) - width[few], width[few])
        seen = np.unique(which * self.size + side.last[low[which] + within])
        every = (many[:, None] * self.size + np.arange(self.size)).ravel()
        keys = np.concatenate([seen, every])
        which, symbol = keys // self.size, keys % self.size
        letters = symbol > _MARK
        return which[letters], symbol[letters]


def near_words(
    index: BidirectionalIndex, flat: np.ndarray, start: np.ndarray, length: np.ndarray, first: bool
) -> tuple[np.ndarray, np.ndarray]:
    """(query, word of the index) one edit apart with the edit in the second half, or the first.

    Query q is ``flat[start[q]:][:length[q]]``. ``first``: the first half is matched exactly.
    """
    count = len(start)
    half = length // 2
    exact = half if first else length - half
    # the exact half and the delimiter beside it, from the middle of the word outwards
    states, alive = index.whole(count), np.arange(count)
    found_states = np.zeros_like(states)
    for step in range(int(exact.max(initial=0)) + 1):
        inner = step < exact[alive]
        at = start[alive] + (half[alive] - 1 - step if first else half[alive] + step)
        symbol = np.where(inner, flat[np.where(inner, at, 0)], _MARK)
        states = index.extend(states, symbol, left=first)
        ended = ~inner & (states[:, 0] < states[:, 1])
        found_states[alive[ended]] = states[ended]
        going = inner & (states[:, 0] < states[:, 1])
        states, alive = states[going], alive[going]
    # then outwards over the other half: ``done`` letters of it, without and with an edit so far
    free = np.flatnonzero(found_states[:, 0] < found_states[:, 1])
    free_states, done = found_states[free], 0
    rest = length - exact

    def letter(query, position):
        return flat[start[query] + (half[query] + position if first else half[query] - 1 - position)]

    used, used_states, used_done = free[:0], free_states[:0], free[:0]
    queries, words = [], []
    while len(free) or len(used):
        nexts = []
        if len(used):
            inner = used_done < rest[used]
            position = np.where(inner, used_done, 0)
            symbol = np.where(inner, letter(used, position), _MARK)
            moved = index.extend(used_states, symbol, left=not first)
            there = moved[:, 0] < moved[:, 1]
            ended = there & ~inner
            queries.append(used[ended])
            words.append(index.word[moved[ended, 0] - index.mark])
            going = there & inner
            nexts.append((used[going], moved[going], used_done[going] + 1))
        if len(free):
            inner = done < rest[free]
            own = np.where(inner, letter(free, np.where(inner, done, 0)), _MARK)
            nexts.append((free[inner], free_states[inner], np.full(inner.sum(), done + 1)))  # a letter less
            which, symbol = index.choices(free_states, left=not first)
            other = symbol != own[which]
            which, symbol = which[other], symbol[other]
            moved = index.extend(free_states[which], symbol, left=not first)
            there = moved[:, 0] < moved[:, 1]
            which, moved = which[there], moved[there]
            nexts.append((free[which], moved, np.full(len(which), done)))  # a letter more
            swapped = inner[which]
            nexts.append((free[which][swapped], moved[swapped], np.full(swapped.sum(), done + 1)))
            matched = index.extend(free_states[inner], own[inner], left=not first)
            there = matched[:, 0] < matched[:, 1]
            free, free_states, done = free[inner][there], matched[there], done + 1
        used, used_states, used_done = (np.concatenate(x) for x in zip(*nexts, strict=True))
    if not queries:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    size = len(index.word)
    pairs = np.unique(np.concatenate(queries) * size + np.concatenate(words))
    return pairs // size, pairs % size


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words in a row, with starts and lengths."""
    length = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return flat, np.cumsum(length) - length, length


def _search_group(table: pa.Table) -> pa.Table:
    """Per query of a group: its near words in the group's index, counted, and the most frequent."""
    names, counts = table["word"].to_pylist(), table["n"].to_pylist()
    indexed, asked = table["indexed"].to_pylist(), table["asked"].to_pylist()
    first = table["first"][0].as_py()
    own = sorted((w, n) for w, n, yes in zip(names, counts, indexed, strict=True) if yes)
    queries = [w for w, yes in zip(names, asked, strict=True) if yes]
    out: dict[str, list] = {"word": [], "n_near": [], "form_n": [], "form": []}
    if own and queries:
        flat, start, length = _points([w for w, _ in own])
        q_flat, q_start, q_length = _points(queries)
        letters = np.unique(np.concatenate([flat, q_flat]))
        symbols = np.searchsorted(letters, flat) + _MARK + 1
        index = BidirectionalIndex(np.split(symbols, start[1:]), len(letters) + _MARK + 1)
        q_symbols = np.searchsorted(letters, q_flat) + _MARK + 1
        frequency = np.array([n for _, n in own])
        for low in range(0, len(queries), SEARCHED):
            part = slice(low, low + SEARCHED)
            query, word = near_words(index, q_symbols, q_start[part], q_length[part], first)
            query = query + low
            if not first:  # pairs that share the first half too are found from there
                kept = [
                    own[v][0][: len(queries[q]) // 2] != queries[q][: len(queries[q]) // 2]
                    for q, v in zip(query.tolist(), word.tolist(), strict=True)
                ]
                query, word = query[kept], word[kept]
            by = np.lexsort((word, -frequency[word], query))  # words of the index are in order
            query, word = query[by], word[by]
            head = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else query
            near = np.diff(np.append(head, len(query)))
            for q, v, n in zip(query[head].tolist(), word[head].tolist(), near.tolist(), strict=True):
                out["word"].append(queries[q])
                out["n_near"].append(n)
                out["form_n"].append(own[v][1])
                out["form"].append(own[v][0])
    types = {"word": pa.string(), "n_near": pa.int64(), "form_n": pa.int64(), "form": pa.string()}
    return pa.table({k: pa.array(v, types[k]) for k, v in out.items()})


def _dealt(words: DataFrame, index_symbols: int) -> DataFrame:
    """The vocabulary in groups of bounded size, once by first and once by last letters.

    Rare keys share a group. A key with too many words for one index is cut into slices, and every
    slice of it as an index meets every slice of it as queries.
    """
    keys = F.array(
        F.struct(F.lit(True).alias("first"), F.substring("word", 1, KEY).alias("key")),
        F.struct(F.lit(False).alias("first"), F.substring("word", -KEY, KEY).alias("key")),
    )
    rows = stored(words.select("word", "n", F.inline(keys)), "word-keys")
    size = F.sum(F.char_length("word") + 1).alias("symbols")
    sizes = stored(rows.groupBy("first", "key").agg(size), "key-sizes")
    total = sizes.filter("first").agg(F.sum("symbols")).first()[0] or 0
    groups = -(-total // index_symbols) or 1
    slices = F.ceil(F.col("symbols") / index_symbols).cast("long").alias("slices")
    hashed = F.xxhash64("key")
    group = F.when(F.col("symbols") > index_symbols, hashed).otherwise(F.pmod(hashed, F.lit(groups)))
    sizes = sizes.select("first", "key", slices, group.alias("g"))
    mine = F.pmod(F.xxhash64("word"), F.col("slices")).alias("mine")
    i, k, w = F.col("i"), F.col("slices"), F.col("mine")
    met = i - k + (i - k >= w).cast("long")
    return (
        rows.join(sizes, ["first", "key"])
        .select("word", "n", "first", "g", "slices", mine)
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), 2 * k - 2)))
        .select(
            "word", "n", "first", "g",
            F.when(i < k, w).otherwise(met).alias("index_slice"),
            F.when(i < k, i).otherwise(w).alias("query_slice"),
            (i < k).alias("indexed"),
            ((i >= k) | (i == w)).alias("asked"),
        )
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the chain of forms. Counts grow along a chain, so it ends; and a
    word has few near words, so none is the form of very many."""
    step, ahead = 0, stored(forms.select("word", F.col("form").alias("root")), "roots-0")
    while True:
        step += 1
        further = ahead.select(F.col("word").alias("w_"), F.col("root").alias("r_"))
        joined = ahead.join(further, F.col("root") == F.col("w_"), "left")
        joined = stored(joined.select("word", F.coalesce("r_", "root").alias("root"), "r_"), f"roots-{step}")
        ahead = joined.select("word", "root")
        if joined.filter(F.col("r_").isNotNull()).isEmpty():
            return ahead


def spelling_variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    noise: int = NOISE,
    index_symbols: int = INDEX_SYMBOLS,
) -> DataFrame:
    """One row per word of the vocabulary: word, form, root, n, n_near, form_n.

    Null and empty texts have no words; runs of rows without a doc_id lose no letter; repeated rows
    count each, ties between forms go to the least word in code-point order. Very long texts are read
    whole, and a very long word is an index of its own. Columns besides doc_id and text are ignored. An
    empty table gives no rows. ``least_length`` is 2 * KEY at least.
    """
    if least_length < 2 * KEY:
        raise ValueError(f"words need {2 * KEY} letters, so that a half of them holds a key")
    words = stored(vocabulary(docs, least_length, least_count, noise), "vocabulary")
    groups = _dealt(words, index_symbols).groupBy("first", "g", "index_slice", "query_slice")
    part = "word string, n_near long, form_n long, form string"
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))  # text compares by code point
    found = groups.applyInArrow(_search_group, part).groupBy("word")
    near = found.agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    near = stored(near.select("word", "n_near", (-F.col("best.less")).alias("m"), "best.form"), "near-words")
    rows = words.join(near, "word", "left")
    enough = F.col("m") >= ratio * F.col("n")
    rows = rows.select(
        "word",
        F.when(enough, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("m")).alias("form_n"),
    )
    rows = stored(rows, "forms")
    roots = _roots(rows.filter(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


# The same in SQL: the checksum of every different run of a document byte by byte with a table made by its
# rule (reversed polynomial 0xEDB88320), near words by the letters that are left when one is taken away.
OP13_SQL = r"""WITH RECURSIVE bits AS (
  SELECT b AS byte, b::UBIGINT AS c, 0 AS k FROM range(256) t(b)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hexed AS (SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM counted),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(1, length(x), 2),
      lambda i: ('0x' || substr(x, i::INT, 2))::UBIGINT),
      lambda h, b: xor(h >> 8, t[(xor(h, b) & 255)::INT + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT) AS h
  FROM hexed, crc
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
      ELSE run END AS word, n
  FROM hashed
), v AS (
  SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (
  SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)
), near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, min({'less': -m, 'other': other}) AS b FROM near GROUP BY word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -b.less >= 5 * v.n THEN b.other END AS form, CASE WHEN -b.less >= 5 * v.n THEN -b.less END AS form_n
  FROM v LEFT JOIN best ON v.word = best.word
), chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM forms f JOIN (SELECT c.word, c.root FROM chain c JOIN forms e ON c.root = e.word WHERE e.form IS NULL) r ON f.word = r.word
"""
