import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ranktrail.llm import spelling
from ranktrail.llm.common import documents as stored_documents
from tests.conftest import SMALL
from tests.llm.brute import UPPER, documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")
NAMES = ("word", "form", "root", "n", "n_near", "form_n")


def _one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def _counts(rows, noise=199):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def _variants(n):
    """By all deletions of all words: words one apart share one, or one is a deletion of the other."""
    shorter = {}
    for w in n:
        for s in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            shorter.setdefault(s, set()).add(w)
    near = {w: set() for w in n}
    for group in shorter.values():
        for a in group:
            near[a] |= {b for b in group if _one_apart(a, b)}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], 0)) for w in n)


def _got(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


@pytest.mark.parametrize("symbols", [spelling.INDEX_SYMBOLS, 300])
def test_whole_table_against_deletions_of_all_words(spark, symbols):
    docs = stored_documents(spark, SMALL.replace("sf0.001", "sf0.01"))
    if symbols < 1000:
        docs = stored_documents(spark, SMALL)
    wanted = _variants(_counts([(r.doc_id, r.text) for r in docs.collect()]))
    got = spelling.spelling_variants(docs, index_symbols=symbols)
    assert tuple(got.columns) == NAMES
    assert _got(got) == wanted
    assert sum(r[4] > 0 for r in wanted) > 20


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_sql_gives_the_same_rows(size):
    folder = SMALL.replace("sf0.001", size)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
        found = db.sql(spelling.OP13_SQL)
        assert tuple(found.columns) == NAMES
        rows = found.fetchall()
        docs = db.execute("SELECT doc_id, text FROM documents").fetchall()
    got = sorted((word, form or "", root, n, near, m or 0) for word, form, root, n, near, m in rows)
    assert got == _variants(_counts(docs))


def _edits(draw, word, letters):
    i = draw.randrange(len(word))
    return draw.choice([word[:i] + word[i + 1 :], word[:i] + draw.choice(letters) + word[i:],
                        word[:i] + draw.choice(letters) + word[i + 1 :]])


@pytest.mark.parametrize("seed", range(4))
def test_search_finds_every_pair(seed):
    draw = random.Random(seed)
    letters = "ab" if seed % 2 else "abcéÿ"
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(6, 12))) for _ in range(150)}
    words |= {w for x in list(words) if len(w := _edits(draw, x, letters)) >= 6}
    words = sorted(words)
    own = words[: len(words) * 2 // 3]  # some queries are not in the index
    points, _, _ = spelling._points(words)
    alphabet = np.unique(points)

    def symbols(part):
        flat, start, length = spelling._points(part)
        return np.searchsorted(alphabet, flat) + 2, start, length

    flat, start, _ = symbols(own)
    index = spelling.BidirectionalIndex(np.split(flat, start[1:]), len(alphabet) + 2)
    pairs = set()
    for first in (True, False):
        found = zip(*spelling.near_words(index, *symbols(words), first))
        found = [(words[q], own[v]) for q, v in found]
        assert len(found) == len(set(found))
        for a, b in found:
            half = len(a) // 2
            assert b.startswith(a[:half]) if first else b.endswith(a[half:])
        pairs |= set(found)
    assert pairs == {(a, b) for a in words for b in own if _one_apart(a, b)}


def test_intervals_of_both_directions_stay_in_step():
    text = ["banana", "bandana", "cabana"]
    flat, start, _ = spelling._points(text)
    index = spelling.BidirectionalIndex(np.split(flat - 95, start[1:]), 30)
    joined = "|" + "|".join(text) + "|"
    state, string = index.whole(1), ""
    for symbol, left in (("a", True), ("n", False), ("a", False), ("b", True), ("|", True), ("n", False)):
        state = index.extend(state, np.array([1 if symbol == "|" else ord(symbol) - 95]), left)
        string = symbol + string if left else string + symbol
        low, high, mirror_low, mirror_high = state[0]
        assert high - low == mirror_high - mirror_low == len(re.findall(f"(?={re.escape(string)})", joined))


def test_a_busy_key_is_cut_into_slices(spark):
    draw = random.Random(7)
    words = sorted({"pre" + "".join(draw.choice("ab") for _ in range(draw.randint(3, 9))) + "fix" for _ in range(300)})
    docs = documents(spark, [" ".join(words)] * 5 + [words[3] + " "] * 40)
    n = _counts([(r.doc_id, r.text) for r in docs.collect()])
    dealt = spelling._dealt(docs.sparkSession.createDataFrame(list(n.items()), "word string, n long"), 400)
    parts = dealt.groupBy("first", "g", "index_slice", "query_slice").agg(
        F.sum((F.col("indexed")).cast("int")).alias("i"), F.sum(F.col("asked").cast("int")).alias("q")
    )
    assert parts.agg(F.max("i"), F.max("q")).first()[0] < 90
    assert _got(spelling.spelling_variants(docs, index_symbols=400)) == _variants(n)


def test_odd_texts(spark):
    phrase = "Banana bananas BANANA bandana Écoleée écoleée ecoleeé "
    long_word = "q" * 2_000
    texts = [None, "", "short", phrase * 6, phrase * 30, (long_word + " ") * 6, (long_word[1:] + "× ") * 5,
             "x1banana_bananax" * 5, "same text banana " * 7, "same text banana " * 7]
    docs = documents(spark, texts).withColumns({n: F.lit(n) for n in ("word", "n", "key", "root", "g")})
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    n = _counts(rows)
    assert _got(spelling.spelling_variants(docs)) == _variants(n)
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert _got(spelling.spelling_variants(nameless)) == _variants(_counts([(None, t) for _, t in rows]))
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs, least_length=5)
