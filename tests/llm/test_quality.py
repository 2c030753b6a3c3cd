import math
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ranktrail.llm import common, quality
from ranktrail.llm.common import documents as stored_documents
from tests.conftest import SMALL
from tests.llm.brute import DOCUMENT, WORD, base_counts, documents

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _buckets(text, buckets=quality.LEAST_BUCKETS):
    one = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in WORD.findall(text or "")]
    two = []
    for a, b in zip(one, one[1:]):
        first = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), seed=42)
        two.append(xxhash.xxh64_intdigest(b.to_bytes(8, "little"), seed=first))
    return [h % buckets for h in [*one, *two]]


def _fold(text):
    return _signed(xxhash.xxh64_intdigest((text or "").encode(), seed=42)) % 2


def test_counts_and_scores_against_plain_ones(spark, labels):
    docs = stored_documents(spark, SMALL)
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    raw, trusted = Counter(), (Counter(), Counter())
    for i, text in texts.items():
        raw.update(_buckets(text))
        if i in good:
            trusted[_fold(text)].update(_buckets(text))
    r_all = sum(raw.values())

    def ratio(b, fold):
        other = trusted[1 - fold]
        expected = raw[b] * sum(other.values()) / r_all
        return round(1e6 * math.log((other[b] + quality.SMOOTHING) / (expected + quality.SMOOTHING)))

    def score(text):
        grams = _buckets(text)
        return sum(ratio(b, _fold(text)) for b in grams) / max(1, len(grams)) / 1e6

    known = {texts[i] for i in good if len(WORD.findall(texts[i] or "")) >= 20}
    threshold = np.quantile([score(t) for t in known], quality.QUANTILE)
    for r in quality.quality_rules(docs, labels).collect():
        assert tuple(r[c] for c in COUNTS) == base_counts(texts[r.doc_id])
        assert r.score == pytest.approx(score(texts[r.doc_id]), abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= threshold - 1e-12)


@pytest.fixture(scope="module")
def shares(spark):
    """Shares of documents kept, by size of the tables and trusted rows, of those that pass the base rules."""
    spam = r"(?s)^\s*(\S*[^\s#*&$%](###|\*\*\*|&&&|\$\$\$|%%%)\s+){8}"
    found = {}

    def of(size, rows):
        if (size, rows) not in found:
            folder = SMALL.replace("sf0.001", size)
            labels = spark.read.parquet(f"{folder}/labels.parquet")
            judged = quality.quality_rules(stored_documents(spark, folder), labels, rows).filter("NOT base_failed")
            trusted = quality.trusted_ids(labels, rows).withColumn("used", F.lit(True))
            known = judged.join(labels.select("doc_id", F.col("quality").alias("q")), "doc_id", "left")
            known = known.join(trusted, F.col("doc_id") == F.col("t_"), "left")
            good, used = F.col("q") == 1, F.col("used").isNotNull()
            groups = {
                "bad": F.col("q") == 0, "trusted": good & used, "good": good & ~used,
                "spam": F.col("text").rlike(spam), "all": F.lit(True),
            }
            passed = F.col("kept").cast("int")
            row = known.agg(*[F.avg(F.when(g, passed)).alias(name) for name, g in groups.items()]).first()
            found[size, rows] = row.asDict()
        return found[size, rows]

    return of


def test_labelled_documents_are_told_apart(shares):
    for size in ("sf0.01", "sf0.1"):
        kept = shares(size, quality.TRUSTED_ROWS)
        assert kept["trusted"] > 0.95 and kept["bad"] < 0.1 and kept["spam"] < 0.15, (size, kept)


def test_good_documents_outside_the_trusted_ones_stay(shares):
    """With 8 % of the labelled good documents as trusted ones."""
    every, kept = shares("sf0.1", quality.TRUSTED_ROWS), shares("sf0.1", 280)
    assert kept["good"] > 0.95 and kept["bad"] < 0.1, kept
    assert abs(kept["all"] - every["all"]) < 0.03


def test_share_kept_does_not_depend_on_the_size(shares):
    small, large = (shares(size, quality.TRUSTED_ROWS) for size in ("sf0.01", "sf0.1"))
    assert abs(small["all"] - large["all"]) < 0.03
    assert large["bad"] <= small["bad"] + 0.01 and large["spam"] <= small["spam"]


def test_buckets_follow_the_trusted_sample(spark, labels, monkeypatch):
    docs = stored_documents(spark, SMALL)
    monkeypatch.setattr(quality, "LEAST_BUCKETS", 1)
    sizes = [quality.bucket_count(docs, quality.trusted_ids(labels, n)) for n in (0, 5, 40)]
    assert sizes[0] == 1 < sizes[1] < sizes[2] and all(n & (n - 1) == 0 for n in sizes)
    monkeypatch.setattr(quality, "MOST_BUCKETS", 16)
    assert quality.bucket_count(docs, quality.trusted_ids(labels)) == 16


def test_odd_texts(spark, labels):
    phrase = "a b c d e f g h "
    texts = [
        None, "", " \n\t", "x", phrase * 2 + "i " * 3, phrase * 30, "w " * 7, "w " * 8, "w " * 9,
        "l\n l\nl\n\n\nl", "\u00a0é #*$%&|<> \x0b\x0c\r1", " ".join(f"w{i}" for i in range(30_000)),
        "one two\n" * 12, phrase + "z " + phrase, "same text here " * 9, "same text here " * 9,
    ]
    docs = documents(spark, texts).withColumns({n: F.lit(n) for n in ("m", "t_", "row_", "score", "h_", "b", "ones_", "n")})
    rows = quality.quality_rules(docs, labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in COUNTS) == base_counts(texts[r.doc_id])
        assert (r.m, r.t_, r.row_) == ("m", "t_", "row_")


def test_empty_tables_and_no_labels(spark, labels):
    docs = documents(spark, ["a b " * 30, None])
    rows = quality.quality_rules(docs, labels.limit(0)).collect()
    assert {r.score for r in rows} == {0.0}
    assert quality.quality_rules(docs.limit(0), labels).count() == 0
    odd = spark.createDataFrame([(None, 1, 0), (5, None, 0), (6, 1, 0), (6, 1, 0)], labels.schema)
    assert [r.t_ for r in quality.trusted_ids(odd).collect()] == [6]
    unnamed = spark.createDataFrame([(None, "a b " * 30, None, None, None)], DOCUMENT)
    assert quality.quality_rules(unnamed, labels).first().doc_id is None


def test_every_good_label_is_trusted(spark):
    labels = spark.range(25_000).select(
        F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic")
    )
    assert quality.trusted_ids(labels).count() == 25_000
    plan = quality.trusted_ids(labels)._jdf.queryExecution().toString()
    assert "Limit" not in plan


@pytest.mark.parametrize("blocks", [0, common.MOST_BLOCKS])
def test_listed_by_bitmap_and_by_join(spark, monkeypatch, blocks):
    monkeypatch.setattr(common, "MOST_BLOCKS", blocks)
    ids = [0, 1, 7, 8, 32767, 32768, 32769, 65536, 65537, -1, -32768, -32769, 2**62, 2**63 - 1, -(2**63)]
    near = {i + d for i in ids for d in (-1, 0, 1) if -(2**63) <= i + d < 2**63}
    docs = spark.createDataFrame([(i, "x") for i in [*near, None]], "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in ids], "t_ long")
    got = {r.doc_id: r.t_ for r in common.with_listed(docs, trusted).collect()}
    assert got == {i: i in ids for i in [*near, None]}


@pytest.mark.parametrize("n", [0, 1, 2, 101, 5000])
def test_threshold_is_the_exact_quantile(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(0, 2, n), 3) + rng.integers(0, 3, n) * 1e-10
    rows = [(float(v), 50, True) for v in values] + [(-30.0, 5, True), (-30.0, 50, False)]
    scores = spark.createDataFrame(rows, "score double, n int, t boolean")
    for q in (0.0, 0.01, 0.5, 1.0):
        wanted = np.quantile(values, q) if n else 0.0
        assert quality.quality_threshold(scores, q) == pytest.approx(wanted, abs=1e-13)
