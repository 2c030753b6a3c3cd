import numpy as np
import pytest

from ranktrail.llm import metricjoin
from ranktrail.llm.components import connected_components
from tests.llm.brute import roots

SCHEMA = "vec_id long, embedding array<float>, label int"


def _expected(rows, cosine=0.9):
    good = []
    for i, (vec_id, v, _) in enumerate(rows):
        if vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append((i, np.array(v, float) / np.linalg.norm(np.array(v, float))))
    links = {i: [] for i in range(len(rows))}
    for x, (i, a) in enumerate(good):
        for j, b in good[x + 1 :]:
            if len(a) == len(b) and a @ b >= cosine:
                links[i].append(j)
                links[j].append(i)
    ids = {i: r[0] for i, r in enumerate(rows)}
    tree = [(ids[i], ids[j]) for i in links for j in links[i]]
    component = roots({k for k in ids.values() if k is not None}, tree)
    return sorted(
        ((ids[i] is None, ids[i] or 0), len(links[i]), component.get(ids[i])) for i in links
    )


@pytest.mark.parametrize("block", [2048, 16])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(metricjoin, "CELL_ROWS", 40)
    monkeypatch.setattr(metricjoin, "BLOCK", block)
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(12, 8))
    vectors = [
        (centres[draw.integers(12)] + draw.normal(scale=0.35, size=8)).astype(np.float32).tolist()
        for _ in range(400)
    ]
    vectors += [vectors[0]] * 30 + [[2 * x for x in vectors[1]], [-x for x in vectors[2]]]
    rows = [(i, v, i % 5) for i, v in enumerate(vectors)]
    rows += [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 8, 0), (1003, [1.0, None] + [0.0] * 6, 0)]
    rows += [(1004, [float("nan")] * 8, 0), (1005, [float("inf")] + [0.0] * 7, 0)]
    rows += [(1006, [1.0, 0.0], None), (1007, [1.0, 0.1], None), (None, vectors[0], 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "n_links")
    got = metricjoin.range_join(docs).collect()
    found = sorted(((r.vec_id is None, r.vec_id or 0), r.n_links, r.component_id) for r in got)
    assert found == _expected(rows)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_empty_table(spark):
    assert metricjoin.range_join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 180)] + [(300, 300 + i) for i in range(50)]
    links += [(7, 7), (None, 3), (5, 4), (4, 5), (350, 179)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    found = {r.node: r.component for r in got.collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert found == roots({x for pair in real for x in pair}, real)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_that_share_a_vec_id_stay_apart(spark):
    """A vector that cannot link beside one that can, and two different vectors, under one vec_id."""
    rows = [
        (1, [1.0, 0.0], 0), (1, None, 0), (1, [0.0, 0.0], 0), (2, [1.0, 0.01], 0), (3, [0.0, 1.0], 0),
        (3, [0.0, 1.0], 0), (2, [0.01, 1.0], 0),
    ]
    got = metricjoin.range_join(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == sorted([
        (1, 1, 1, True), (1, 0, 1, True), (1, 0, 1, True), (2, 1, 1, False),
        (3, 2, 2, False), (3, 2, 2, False), (2, 2, 2, True),
    ])
