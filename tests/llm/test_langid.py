import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ranktrail.llm import bytegru, langid
from ranktrail.llm.common import documents as stored_documents
from tests.conftest import SMALL
from tests.llm.brute import DOCUMENT, documents

TEXTS = [b"the cat", b"", b"x", "ça va être là".encode(), bytes(range(256)) * 2]


def _chunk(texts=TEXTS):
    offsets = np.cumsum([0] + [len(t) for t in texts])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def _plain_unit(weights, side, data):
    """One byte at a time."""
    table, inner = (weights[f"{side}_{x}"].astype(float) for x in ("bytes", "state"))
    hidden = inner.shape[0]
    h, out = np.zeros(hidden), []
    for b in data:
        given, pushed = table[b], h @ inner
        x = given[: 2 * hidden] + pushed[: 2 * hidden]
        gates = 0.5 + 0.5 * x / (1 + abs(x))
        y = given[2 * hidden :] + gates[hidden:] * pushed[2 * hidden :]
        h = (1 - gates[:hidden]) * y / (1 + abs(y)) + gates[:hidden] * h
        out.append(h)
    return np.array(out)


def test_every_position_against_a_plain_network():
    weights = bytegru.new_weights(3, 5, seed=4)
    data, offsets = _chunk()
    got = bytegru.pooled(weights, data, offsets, span=16, batch=3)
    for i, text in enumerate(TEXTS):
        total = np.zeros(3)
        for low in range(0, len(text), 16):
            part = text[low : low + 16]
            ahead = _plain_unit(weights, "ahead", part)
            back = _plain_unit(weights, "back", part[::-1])[::-1]
            scores = ahead @ weights["ahead_out"] + back @ weights["back_out"] + weights["bias"]
            odds = np.exp(scores)
            total += (odds / odds.sum(1, keepdims=True)).sum(0)
        assert got[i] == pytest.approx(total / max(1, len(text)), abs=1e-5)


def test_gradients_against_differences():
    draw = np.random.default_rng(3)
    weights = {k: w.astype(np.float64) for k, w in bytegru.new_weights(3, 4, seed=1).items()}
    data, offsets = _chunk()
    text, start, length = bytegru.spans(data, offsets, 16)
    label = np.arange(len(start)) % 3
    _, slope = bytegru.gradients(weights, data, start, length, label)
    for name, w in weights.items():
        for _ in range(8):
            at = tuple(draw.integers(n) for n in w.shape)
            if name.endswith("bytes"):
                at = (int(data[draw.integers(len(data))]), at[1])
            old, sides = w[at], []
            for step in (1e-5, -1e-5):
                w[at] = old + step
                sides.append(bytegru.gradients(weights, data, start, length, label)[0])
            w[at] = old
            assert slope[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6)


def test_held_out_accuracy(spark):
    docs = stored_documents(spark, SMALL.replace("sf0.001", "sf0.01"))
    rows = langid.identify_languages(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    tested = [r for r in rows if r.held_out and r.text and r.lang]
    assert len(tested) > 250
    assert np.mean([r.lang == r.lang_pred for r in tested]) > 0.97
    for lang in {r.lang for r in tested}:
        assert np.mean([r.lang_pred == lang for r in tested if r.lang == lang]) > 0.9


def test_labels_of_held_out_documents_do_not_matter(spark):
    docs = stored_documents(spark, SMALL)
    spoiled = docs.withColumn(
        "lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))
    ).withColumn("source", F.lit("other"))
    plain, other = (
        {r.doc_id: (r.lang_pred, r.score) for r in langid.identify_languages(d, steps=20).collect()}
        for d in (docs, spoiled)
    )
    assert plain == other


def test_sample_is_bounded_by_language(spark):
    texts = ["the and of " * 100] * 300 + ["der die das " * 100] * 20
    docs = documents(spark, texts)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") < 300, "en").otherwise("de"))
    counts = langid.training_spans(docs, train_docs=10).groupBy("lang").count().collect()
    assert {r["lang"] for r in counts} == {"en", "de"}
    assert max(r["count"] for r in counts) <= 10 * langid.TRAIN_SPANS


def test_odd_texts(spark):
    rows = [
        (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, " 12 \n!? ½²", "en", "s", 0), (4, "a", "en", "s", 1),
        (None, "the and of " * 30, "en", "s", 1), (5, "der die das " * 30, None, "s", 1),
        (6, "é", "fr", "s", 1), (7, "the and " * 40_000, "en", "s", 1), (7, "the and " * 9, "en", "s", 1),
        (7, "the and " * 9, "en", "s", 1), (8, "der die das " * 40, "de", "s", 1), (9, "der die " * 40, "de", "s", 1),
    ]
    docs = spark.createDataFrame(rows, DOCUMENT)
    docs = docs.withColumns({n: F.lit(n) for n in ("l_", "n", "h", "r", "row_", "text_", "lettered_", "score")})
    got = langid.identify_languages(docs, steps=30).collect()
    assert len(got) == len(rows)
    learned = {r[2] for r in rows if r[0] and r[1] and r[2] and zlib.crc32(str(r[0]).encode()) % 3 != 1}
    for r in got:
        assert r.row_ == "row_" and r.text_ == "text_"
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in learned and 0 < r.score <= 1
        assert r.held_out or r.doc_id is not None
    unlabelled = langid.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    empty = langid.identify_languages(docs.limit(0))
    assert empty.count() == 0
