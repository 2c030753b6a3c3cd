import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ranktrail.llm import bestfit, minhash, mixing, quality, runindex
from ranktrail.llm.common import documents, stored
from tests.conftest import SMALL
from tests.llm.brute import near_duplicates, repeats


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage made of what the one before it left."""
    docs, out = documents(spark, SMALL), []
    out.append(docs)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, SMALL), f"test-stage-{i}")
        out.append(docs)
    return out


def _texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_act_on_all_they_get(spark, steps):
    given, good, distinct, cut, mixed, packed = steps
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = quality.quality_rules(given, labels).filter("kept")
    assert sorted(_texts(good)) == sorted(r.doc_id for r in kept.collect())
    groups = near_duplicates(_texts(good))
    assert sorted(_texts(distinct)) == sorted(i for i, (_, c) in groups.items() if i == c)
    before, after = _texts(distinct), _texts(cut)
    for i, (n, removed, _, _) in zip(before, repeats(list(before.values()), corpus_pipeline.PASSAGE_BYTES), strict=True):
        lost = n - len(after[i].encode())
        assert lost == removed or removed and removed <= lost <= removed + 6
    sized = mixing.measured(cut)
    copies = mixing.copies_of(sized, mixing.draw_plan(sized, (1, 2, 3))).collect()
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r.row_.doc_id: r.copies for r in copies if r.copies}
    tokens = bestfit.token_pieces(mixed).agg({"length": "sum"}).first()[0]
    used = {}
    for r in packed.collect():
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= bestfit.WIDTH
    assert sum(n for parts in used.values() for _, n in parts) == tokens


def test_all_but_the_last_return_documents(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert minhash.PERCENT == 85 and runindex.LENGTH == 400


def test_run_is_the_registered_query(spark, steps):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    got = corpus_pipeline.run(spark, SMALL)
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(got.select(columns).collect()) == sorted(steps[-1].select(columns).collect())


def test_columns_named_like_results_keep_their_values(spark):
    docs = documents(spark, SMALL)
    plain = corpus_pipeline.quality_rules(spark, docs, SMALL)
    names = ("score", "kept", "n_words", "row_", "given_", "th", "total")
    more = docs.withColumns({n: F.lit(n) for n in names})
    got = corpus_pipeline.quality_rules(spark, more, SMALL)
    assert got.columns == more.columns
    wanted = plain.withColumns({n: F.lit(n) for n in names})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_stages_take_empty_tables(spark):
    empty = documents(spark, SMALL).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
