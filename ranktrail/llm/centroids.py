"""Centroid clustering of integer vectors with an incremental distance matrix.

Every vector keeps its exact dot product with every centroid in a written table. A round sends the
tasks only the components in which a centroid changed, with the differences; they are added to the
kept products, and the squared distance |v|^2 - 2 v.c + |c|^2 gives the nearest centroid anew.
All of it is integer arithmetic, so results do not depend on order or on how rows are split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm.common import stored
from ranktrail.session import remove

WIDTH = 64
CLUSTERS = 40  # times WIDTH: the numbers that pass through the driver each round
ROUNDS = 5
SCALE = 256
MOST = 1 << 26  # greatest size of a component; with 64 of them a distance fits into a long

_STATE = "vec_id long, v array<int>, dots array<long>, cluster int, distance long"


def quantised(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): integer components of the vectors that take part."""
    v = F.col("embedding")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    near = F.forall(v, lambda x: F.abs(F.floor(x.cast("double") * scale)) <= MOST)
    usable = vectors.filter(F.coalesce((F.size(v) == width) & good, F.lit(False))).filter(near)
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return usable.select(F.col("vec_id").cast("long"), whole.alias("v"))


def first_centroids(whole: DataFrame, clusters: int = CLUSTERS) -> np.ndarray:
    """The vectors of lowest hash; a null vec_id has no hash and is never chosen."""
    named = whole.filter(F.col("vec_id").isNotNull())
    key = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = named.orderBy(key, "v").limit(clusters).select("v").collect()
    return np.array([r.v for r in rows], np.int64)


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel(), kind))


def _update(old: np.ndarray, new: np.ndarray):
    """Products of the vectors with the centroids ``old`` become those with ``new``."""
    changed = [(c, np.flatnonzero(d), d[d != 0]) for c, d in enumerate(new - old) if d.any()]
    norms = (new * new).sum(1)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            v = _matrix(batch["v"], n)
            if "dots" in batch.schema.names:
                dots = _matrix(batch["dots"], n)
            else:
                dots = np.zeros((n, len(new)), np.int64)
            for c, places, differences in changed:
                dots[:, c] += v[:, places] @ differences
            squares = (v * v).sum(1)[:, None] - 2 * dots + norms
            cluster = squares.argmin(1)  # the first of equal ones
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch["vec_id"],
                    "v": _lists(v, pa.int32()),
                    "dots": _lists(dots, pa.int64()),
                    "cluster": pa.array(cluster, pa.int32()),
                    "distance": pa.array(squares[np.arange(n), cluster], pa.int64()),
                }
            )

    return step


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floored means of the clusters; an empty one keeps its centroid. One row per cluster comes back."""
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(centroids.shape[1])]
    moved = centroids.copy()
    for row in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        moved[row.cluster] = [s // row.n for s in row[2:]]
    return moved


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    A vector takes part if it has exactly ``width`` components, none of them null or non-finite;
    others give no row, nor do those with a component beyond ``MOST`` once scaled, whose distances
    no long could hold. The first centroids are the vectors of lowest hash, equal hashes (repeated
    vec_ids) in order of their components; fewer vectors than ``clusters`` make fewer clusters. A null
    vec_id is clustered and stays null, but is never a first centroid; without any vec_id there are no
    centroids and no rows. Repeated rows are rows of their own. Ties go to the smaller number, empty
    clusters keep their centroid. Columns besides vec_id and embedding are ignored. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    results = (
        "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
        "centroid_sha256 string"
    )
    state = stored(quantised(vectors, width, scale), "vectors")
    centroids = first_centroids(state, clusters)
    if not len(centroids):
        return spark.createDataFrame([], results)
    before = np.zeros_like(centroids)
    for number in range(rounds + 1):
        after = stored(state.mapInArrow(_update(before, centroids), _STATE), f"products-{number}")
        remove(spark, *state.inputFiles())  # the new table holds all that is needed
        state, before = after, centroids
        if number < rounds:
            centroids = _means(state, centroids)
    spread = state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    total = sum(r.d for r in spread)
    rows = [
        (r.cluster, r.d, total, hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest())
        for r in spread
    ]
    facts = spark.createDataFrame(
        rows, "c_ int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    placed = state.select("vec_id", "cluster", "distance")
    joined = placed.join(F.broadcast(facts), F.col("cluster") == F.col("c_"))  # a row per cluster
    return joined.drop("c_")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    """Every round in full: distances to all centroids, then floored means."""
    parts = [
        """kept AS (SELECT vec_id,
      list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v AS m
    FROM kept ORDER BY sha256('2:' || vec_id) LIMIT 40)""",
    ]
    for i in range(ROUNDS + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT vec_id, any_value(kept.v) AS v,
      min({{'d': list_sum(list_transform(list_zip(kept.v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'c': c}}) AS b
    FROM kept, c{i} GROUP BY vec_id)"""
        )
        if i == ROUNDS:
            break
        parts.append(
            f"""s{i} AS (SELECT b.c AS c, i, sum(v[i])::HUGEINT AS s, count(*) AS n
    FROM a{i}, range(1, 65) AS r(i) GROUP BY ALL)"""
        )
        parts.append(
            f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(t.m, c{i}.m) AS m FROM c{i} LEFT JOIN
      (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS m FROM s{i} GROUP BY c) t
    ON t.c = c{i}.c)"""
        )
    return f"""WITH {", ".join(parts)}
    SELECT vec_id, CAST(b.c AS INT) AS cluster, CAST(b.d AS BIGINT) AS distance,
      CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia,
      CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
      sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM a{ROUNDS} JOIN c{ROUNDS} ON b.c = c"""


OP11_SQL = _sql()
