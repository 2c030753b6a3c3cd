import pytest
from pyspark.sql import functions as F

from ranktrail.llm import mixing
from tests.llm.brute import DOCUMENT


def _water(sizes, weights):
    """Targets by repeated sharing, as a plain loop."""
    total, free, target = sum(sizes.values()), set(sizes), {}
    while free:
        share = (total - sum(target.values())) / sum(weights[s] for s in free)
        over = {s for s in free if share * weights[s] >= 3 * sizes[s]}
        if not over:
            return target | {s: share * weights[s] for s in free}
        target |= {s: 3 * sizes[s] for s in over}
        free -= over
    return target


@pytest.fixture(scope="module")
def docs(spark):
    rows, i = [], 0
    for source, n, length in [("a", 400, 30), ("B", 300, 9), ("c", 20, 5), (None, 60, 50), ("d", 1, 900)]:
        for k in range(n):
            rows.append((i, "w " * (1 + (k * 7) % length) + "\x0b\u00a0x", "en", source, 1))
            i += 1
    rows += [(i, None, "en", "a", 0), (i + 1, "", "en", "a", 0), (i + 2, " \t\n", "en", "e", 3)]
    return spark.createDataFrame(rows, DOCUMENT)


def _drawn(docs):
    sized = mixing.measured(docs)
    return mixing.copies_of(sized, mixing.draw_plan(sized, (1, 2, 3))).collect()


def test_sources_reach_their_targets(docs):
    rows = _drawn(docs)
    assert len(rows) == docs.count()
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
        assert 0 <= r.copies <= 3
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: 1 + i % 3 for i, s in enumerate(order)}
    expected = _water(sizes, weights)
    for r in rows:
        assert r.target == pytest.approx(expected[r.source]) and r.source_size == sizes[r.source]
        assert abs(taken[r.source] - r.target) <= max(
            x.size for x in rows if x.source == r.source
        )
    assert sum(expected.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_agree_and_copies_follow_expectation(docs):
    first = {r.row_.doc_id: r.copies for r in _drawn(docs)}
    again = _drawn(docs.repartition(7))
    assert {r.row_.doc_id: r.copies for r in again} == first
    assert all(int(r.expected) <= r.copies <= int(r.expected) + 1 for r in again)
    # longer documents are expected more often
    a = {r["class"]: r.expected for r in again if r.source == "a" and r.size}
    assert sorted(a, key=a.get) == sorted(a)


def test_mix_repeats_rows_and_keeps_clashing_columns(docs):
    names = ["size", "class", "u", "rank", "cell", "copies", "target", "row_", "s_", "end"]
    wide = docs.withColumns({n: F.lit(n) for n in names})
    mixed = mixing.mix(wide)
    assert mixed.columns == wide.columns
    copies = {r.row_.doc_id: r.copies for r in _drawn(docs)}
    got = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in copies.items() if v}
    assert mixed.filter(F.col("size") != "size").count() == 0


def test_empty_and_wordless_tables(spark, docs):
    assert mixing.mix(docs.limit(0)).count() == 0
    only = docs.filter("source = 'e'")
    assert {r.copies for r in _drawn(only)} == {1}
