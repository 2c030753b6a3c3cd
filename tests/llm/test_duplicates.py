import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ranktrail.llm import minhash, runindex
from ranktrail.llm.shingles import shingle_sets
from tests.llm.brute import documents, near_duplicates, repeats, shingles


def _texts(seed, families=12):
    draw = random.Random(seed)

    def words(n):
        return [f"w{draw.randrange(4000)}" for _ in range(n)]

    texts = []
    for _ in range(families):
        base = words(draw.choice([3, 6, 12, 40, 200]))
        for _ in range(draw.randint(1, 12)):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                copy[draw.randrange(len(copy))] = f"w{draw.randrange(4000)}"
            texts.append(" ".join(copy))
            base = copy if draw.random() < 0.5 else base  # chains as well as stars
    line = " ".join(words(14))
    texts += [line + " " + " ".join(words(draw.randint(10, 30))) for _ in range(40)]
    texts += [None, "", " \n", "One", "one", "a b c d", "A  B\tc\x0bd", "a b c d e", "ÉA b", "éA b"]
    return texts + texts[:3] + ["long " + " ".join(words(30_000))]


def test_shingle_sets_match_plain_ones():
    texts = _texts(5)
    sizes = {}
    for first, hashes, bounds in shingle_sets(pa.array(texts)):
        for i in range(len(bounds) - 1):
            own = hashes[bounds[i] : bounds[i + 1]]
            assert (np.diff(own.astype(object)) > 0).all()
            sizes[first + i] = own
    assert [len(sizes[i]) for i in range(len(texts))] == [len(shingles(t)) for t in texts]
    for i in range(60):
        for j in range(i):
            common = len(np.intersect1d(sizes[i], sizes[j]))
            assert common == len(shingles(texts[i]) & shingles(texts[j]))


def test_signatures_agree_as_often_as_sets_overlap():
    draw = np.random.default_rng(2)
    for n, share in [(12, 0.9), (60, 0.9), (600, 0.86), (5000, 0.5)]:
        gaps = []
        for _ in range(60):
            common = draw.integers(0, 2**64, int(n * share) or 1, dtype=np.uint64)
            own = [draw.integers(0, 2**64, n - len(common), dtype=np.uint64) for _ in range(2)]
            sets = [np.sort(np.concatenate([common, o])) for o in own]
            bounds = np.cumsum([0, *map(len, sets)])
            a, b = minhash.signatures(np.concatenate(sets), bounds)
            gaps.append((a == b).mean() - len(common) / (2 * n - len(common)))
        assert abs(np.mean(gaps)) < 0.03


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, seed):
    if seed == 2:  # hot buckets and families take the longer way
        monkeypatch.setattr(minhash, "LOCAL", 3)
        monkeypatch.setattr(minhash, "TARGETS", 400)
        monkeypatch.setattr(minhash, "QUERIES", 200)
    texts = _texts(seed)
    docs = documents(spark, texts, first=10)
    expected = near_duplicates({10 + i: t for i, t in enumerate(texts)})
    got = minhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_document_of_each_group_stays(spark):
    texts = ["a b c d e f g", "A b c d e f g", "x y", None, None]
    docs = documents(spark, texts).withColumns({"k_": F.lit(1), "kept": F.lit(2)})
    docs = docs.unionByName(docs.limit(1)).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None)))
    kept = minhash.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 0), (False, 2), (False, 3), (False, 4), (True, 0),
    ]
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    assert got[None].component_id is None and not got[None].kept
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    assert minhash.distinct_documents(docs.limit(0)).count() == 0


def test_run_index_marks_all_repeated_windows():
    draw = random.Random(3)
    for _ in range(60):
        length = draw.choice([7, 20, 28, 57, 100])
        letters = bytes(draw.sample(range(256), draw.choice([1, 2, 26])))
        pool = [bytes(draw.choices(letters, k=draw.randint(5, 3 * length))) for _ in range(4)]
        texts = [
            b"".join(draw.choice(pool) for _ in range(draw.randint(1, 4))).decode("latin-1")
            for _ in range(draw.randint(1, 6))
        ]
        index = runindex.RunIndex(
            [np.frombuffer(t.encode(), np.uint8) for t in texts], length
        )
        start, size = index.repeats()
        start, end = runindex.united(start, start + size)
        for t, at, (n, removed, runs, _) in zip(texts, index.start, repeats(texts, length), strict=True):
            own = [(a, b) for a, b in zip(start, end, strict=True) if at <= a < at + n]
            assert len(own) == runs and sum(b - a for a, b in own) == removed


def test_run_ends_give_the_longest_match_of_every_place():
    draw = random.Random(5)
    for _ in range(60):
        texts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 30))) for _ in range(draw.randint(1, 5))]
        index = runindex.RunIndex([np.frombuffer(t, np.uint8) for t in texts], 4)
        suffixes = {at + i: t[i:] for t, at in zip(texts, index.start, strict=True) for i in range(len(t))}

        def match(p):
            best = 0
            for q, other in suffixes.items():
                n = 0
                while q != p and n < min(len(other), len(suffixes[p])) and other[n] == suffixes[p][n]:
                    n += 1
                best = max(best, n)
            return best

        found = index.matching_statistics()
        assert [found[p] for p in suffixes] == [match(p) for p in suffixes]
        assert index.size.sum() == index.places == sum(len(t) + 1 for t in texts)


def test_index_grows_with_runs_not_with_text():
    draw = np.random.default_rng(2)
    base = draw.integers(97, 110, 2_000).astype(np.uint8)

    def copies(n):
        out = []
        for _ in range(n):
            text = base.copy()
            text[draw.integers(0, len(text), 3)] = 122
            out.append(text)
        return runindex.RunIndex(out, 400)

    few, many = copies(4), copies(64)
    assert many.places > 15 * few.places
    assert len(many.head) < 2.5 * len(few.head)
    kept = sum(v.nbytes for v in vars(many).values() if isinstance(v, np.ndarray))
    assert kept < 8 * 8 * len(many.head) and kept < 3 * many.places


def _long_texts(seed):
    draw = random.Random(seed)

    def prose(n):
        return "".join(draw.choice("abcdeé fg\n") for _ in range(n))

    passages = [prose(n) for n in (90, 130, 200, 700)]
    texts = [
        "".join(draw.choice(passages) if draw.random() < 0.4 else prose(60) for _ in range(draw.randint(1, 9)))
        for _ in range(60)
    ]
    hot = prose(150)
    texts += [prose(40) + hot + prose(40) for _ in range(50)] + [prose(400)] * 3
    return texts + [None, "", "short", "ab" * 600, "é" * 300, prose(20_000)]


@pytest.mark.parametrize("contexts", [1000, 5])
def test_repeats_against_all_windows(spark, monkeypatch, contexts):
    monkeypatch.setattr(runindex, "MOST_CONTEXTS", contexts)
    monkeypatch.setattr(runindex, "INDEX_BYTES", 20_000)
    texts = _long_texts(4)
    docs = documents(spark, texts).withColumnRenamed("lang", "spans")
    docs = docs.unionByName(docs.filter("doc_id = 3"))  # a repeated row repeats its text
    ids = [r.doc_id for r in docs.collect()]
    expected = sorted(zip(ids, repeats([*texts, texts[3]], 120), strict=True))
    rows = runindex.remove_repeats(docs, length=120).collect()
    assert sorted((r.doc_id, tuple(r)[1:5]) for r in rows) == expected
    for r in rows:  # cuts may split an é, whose other half goes too
        lost = r.n_bytes - r.n_removed - len((r.text or "").encode())
        assert 0 <= lost <= 2 * r.n_spans and (r.text is None) == (texts[r.doc_id] is None)


def test_texts_without_repeats(spark):
    half = "é" * 70
    texts = [half + "x", half + "y", "untouched", None]
    docs = documents(spark, texts).withColumns({"d_": F.lit(1), "row_": F.lit(2)})
    rows = {r.doc_id: r for r in runindex.without_repeats(docs, length=100).collect()}
    assert [rows[i].text for i in range(4)] == ["x", "y", "untouched", None]
    assert [rows[i].n_chars for i in range(4)] == [1, 1, 9, None]
    assert runindex.without_repeats(docs).columns == docs.columns
    assert runindex.without_repeats(docs.limit(0)).count() == 0
    assert runindex.remove_repeats(docs.limit(0)).count() == 0


def test_texts_without_repeats_are_not_shuffled(spark, monkeypatch):
    """Rows whose doc_id has no repeat stay out of the shuffles that bring spans and contexts to texts."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), 9)) for _ in range(400)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(40)]
    texts[3] = texts[7][:200] + texts[3][200:]
    docs = documents(spark, [*texts, None])
    taken = []
    part = runindex._parted

    def watched(rows, listed):
        near, far = part(rows, listed)
        taken.append((near.count(), far.count()))
        return near, far

    monkeypatch.setattr(runindex, "_parted", watched)
    rows = {r.doc_id: r for r in runindex.remove_repeats(docs, length=120).collect()}
    assert {i for i, r in rows.items() if r.n_removed} == {3, 7} and len(rows) == 41
    assert taken == [(2, 39), (2, 39)]


def test_windows_of_busy_anchors_take_one_python_worker_a_task(spark, monkeypatch):
    """Contexts are cut and hashed by one Python step; two in a row hold two workers for every task."""
    monkeypatch.setattr(runindex, "MOST_CONTEXTS", 5)
    steps = {}
    store = runindex.stored

    def watched(df, name):
        steps[name] = df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
        return store(df, name)

    monkeypatch.setattr(runindex, "stored", watched)
    runindex.repeated_spans(documents(spark, _long_texts(4)), length=120)
    assert steps["anchors"] == 1 and steps["windows"] == 1


def test_anchor_search_holds_arrays_of_a_small_chunk():
    draw = np.random.default_rng(4)
    texts = [draw.integers(97, 123, 3_000).astype(np.uint8).tobytes().decode() for _ in range(1_000)]
    ids = pa.array(range(1_000), pa.int64())
    batch = pa.RecordBatch.from_pydict({"doc_id": ids, "th": ids, "text": pa.array(texts)})
    find = runindex._find_anchors(400)
    for _ in find([batch.slice(0, 400)]):  # the tables of powers are made
        pass
    tracemalloc.start()
    n = sum(len(part) for part in find([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 1_000 and peak < 40e6
