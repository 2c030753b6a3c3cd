import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ranktrail.llm import centroids
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def _plain(rows, clusters, rounds, width):
    """All distances anew in every round."""
    kept = []
    for vec_id, v, *_ in rows:
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v):
            kept.append((vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    order = sorted(
        (hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None
    )
    middle = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle))

    for _ in range(rounds):
        places = [nearest(v)[1] for _, v in kept]
        for c in range(len(middle)):
            own = [v for (_, v), p in zip(kept, places) if p == c]
            if own:
                middle[c] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return [(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found]


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_against_all_distances(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = vectors.select("vec_id", "embedding").collect()
    got = centroids.cluster_vectors(vectors, clusters=12).collect()
    assert _sorted(got) == _sorted(_plain(rows, 12, centroids.ROUNDS, centroids.WIDTH))


def test_only_changed_components_are_sent():
    old = np.array([[1, 2, 3], [4, 5, 6]])
    new = np.array([[1, 2, 3], [4, 7, 6]])
    step = centroids._update(old, new)
    cells = dict(zip(step.__code__.co_freevars, (c.cell_contents for c in step.__closure__)))
    assert [(c, p.tolist(), d.tolist()) for c, p, d in cells["changed"]] == [(1, [1], [2])]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.1, 0.2], 0), (2, [0.1, 0.2], 0), (2, [0.9, -0.7], 0), (2, [0.9, -0.7], 0), (None, [-0.5, 0.0], 0),
        (3, None, 0), (4, [], 0), (5, [1.0], 0), (6, [1.0, None], 0), (7, [nan, 1.0], 0), (8, [inf, 0.0], 0),
        (9, [0.0, 0.0], None), (10, [-0.001, 0.001], 1), (11, [1e30, 0.0], 1), (12, [1.0, 2.0, 3.0], 1),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns(
        {n: F.lit(n) for n in ("v", "cluster", "dots", "distance", "c_")}
    )
    near = [r for r in rows if r[0] != 11]
    for clusters in (1, 3, 40):
        got = centroids.cluster_vectors(vectors, clusters, 2, width=2).collect()
        assert _sorted(got) == _sorted(_plain(near, clusters, 2, 2))
    nameless = vectors.filter("vec_id IS NULL")
    assert centroids.cluster_vectors(nameless, 3, 2, width=2).count() == 0
    empty = centroids.cluster_vectors(vectors.limit(0), 3, 2, width=2)
    assert empty.count() == 0 and empty.columns == got[0].__fields__


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_sql_gives_the_same_rows(spark, size):
    folder = SMALL.replace("sf0.001", size)
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW embeddings AS FROM '{folder}/embeddings.parquet'")
        wanted = db.sql(centroids.OP11_SQL)
        names, wanted = wanted.columns, wanted.fetchall()
    got = centroids.op11_centroid_clustering(spark, folder).select(*names).collect()
    assert _sorted(got) == _sorted(wanted)
