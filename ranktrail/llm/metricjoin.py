"""Exact range join of vectors by cosine, cut into cells around pivots.

Unit vectors at distance r have the cosine 1 - r * r / 2. Every vector belongs to the cell of its
nearest pivot. A partner within r of a vector x lies in x's own cell or, by the triangle
inequality, is a vector y whose distance to x's pivot is at most its distance to its own pivot
plus 2 r, and at most the radius of x's cell plus r. Such y are sent to x's cell too, so the cell
alone knows all links of its members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm.common import stored
from ranktrail.llm.components import connected_components

COSINE = 0.9
CELL_ROWS = 8_000  # members a cell is meant to have; decides the number of pivots
MOST_PIVOTS = 4_096  # times the width of a vector: all that is broadcast
BLOCK = 8_192  # members that one group holds, and a quarter of its visitors
SLACK = 1e-7  # for rounding in distances, far below any gap that decides a link


def _linkable() -> Column:
    """Can a row's vector link? The others have no neighbours."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return F.col("vec_id").isNotNull() & F.coalesce(good & some, F.lit(False))


def _units(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)  # no overflow or loss in the squares
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _pivots(clean: DataFrame, rows: int) -> np.ndarray:
    """A bounded number of vectors, those of lowest hash, as pivots."""
    wanted = max(1, min(MOST_PIVOTS, rows // CELL_ROWS))
    chosen = clean.orderBy(F.xxhash64("v"), "id").limit(wanted)
    return _units(chosen.select("v").toArrow()["v"].combine_chunks())


def range_join(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other rows whose cosine in double precision is at least ``cosine``
    (above 0); ``component_id`` is the smallest vec_id of the rows reachable over links, itself included. A
    vector that is null, empty, zero or has null or non-finite components links with nothing. Vectors of
    different widths do not link. Equal vectors are compared once and counted each; rows with a
    repeated vec_id are rows of their own, a null vec_id stays null with no link. Columns besides
    vec_id and embedding are ignored. An empty table gives no rows.
    """
    everyone = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    clean = everyone.filter(_linkable()).select("vec_id", F.col("embedding").alias("v"))
    # equal vectors are one node, named by their hash: rows of one vec_id may hold different ones
    groups = stored(
        clean.groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumns({"width": F.size("v"), "id": F.xxhash64("v")}),
        "vectors",
    )
    widths = [w["width"] for w in groups.select("width").distinct().collect()]
    parts = [_joined(groups.filter(F.col("width") == w), cosine) for w in sorted(widths)]
    outcome = groups.select("id", F.col("n").alias("links"), F.lit(None).cast("long").alias("other"))
    for part in parts:
        outcome = outcome.unionByName(part)
    found = stored(outcome, "links")
    totals = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.filter(F.col("other").isNotNull()).select(F.col("id").alias("a"), F.col("other").alias("b"))
    components = connected_components(edges, "vector-components")
    classes = groups.join(totals, "id").join(
        components.withColumnRenamed("node", "id"), "id", "left"
    ).select("v", "links", "least", F.coalesce("component", "id").alias("node"))
    classes = stored(classes, "vector-classes")
    least = stored(classes.groupBy("node").agg(F.min("least").alias("component_id")), "class-ids")
    classes = classes.drop("least").join(least, "node")
    ids = clean.join(classes, "v").select("vec_id", (F.col("links") - 1).alias("n_links"), "component_id")
    rest = everyone.filter(~_linkable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return ids.unionByName(rest).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def _joined(groups: DataFrame, cosine: float) -> DataFrame:
    """(id, links, other): counts of linked rows and tree edges from every block that met."""
    radius = math.sqrt(2 - 2 * cosine)
    rows = groups.count()
    pivots = _pivots(groups, rows)
    homes = stored(_assigned(groups, pivots), "cells")
    stats = homes.groupBy("home").agg(F.count("*").alias("size"), F.max("near").alias("reach"))
    reach = np.full(len(pivots), -np.inf)
    members = np.ones(len(pivots), np.int64)
    for s in stats.collect():  # a row per pivot
        reach[s["home"]], members[s["home"]] = s["reach"], s["size"]
    goes = _Reach(pivots, reach, radius)
    visitors = np.ones(len(pivots), np.int64)
    for s in _visitors(homes, goes).groupBy("cell").agg(F.sum("n").alias("n")).collect():
        visitors[s["cell"]] = s["n"]
    blocks = -(-members // BLOCK), -(-visitors // (4 * BLOCK))
    visits = _visits(homes, goes, *blocks, vectors=homes.schema["v"].dataType.simpleString())
    return visits.groupBy("cell", "mine", "theirs").applyInArrow(
        _meet(cosine), "id long, links long, other long"
    )


def _assigned(groups: DataFrame, pivots: np.ndarray) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            dots = _units(batch["v"]) @ pivots.T
            home = dots.argmax(1)
            near = np.sqrt(np.maximum(0, 2 - 2 * dots[np.arange(len(home)), home]))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch["id"],
                    "n": batch["n"],
                    "v": batch["v"],
                    "home": pa.array(home, pa.int32()),
                    "near": near,
                }
            )

    vectors = groups.schema["v"].dataType.simpleString()
    return groups.select("id", "n", "v").mapInArrow(
        assign, f"id long, n long, v {vectors}, home int, near double"
    )


class _Reach:
    """Which cells a vector visits; its own is one of them."""

    def __init__(self, pivots: np.ndarray, reach: np.ndarray, radius: float):
        self.pivots, self.reach, self.radius = pivots, reach, radius

    def __call__(self, batch: pa.RecordBatch) -> np.ndarray:
        far = np.sqrt(np.maximum(0, 2 - 2 * (_units(batch["v"]) @ self.pivots.T)))
        near = batch["near"].to_numpy()[:, None]
        goes = (far <= near + 2 * self.radius + SLACK) & (far <= self.reach + self.radius + SLACK)
        goes[np.arange(len(goes)), batch["home"].to_numpy()] = True
        return goes


def _visitors(homes: DataFrame, goes: _Reach) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(goes.pivots), np.int64)
        for batch in batches:
            if len(batch):
                n += goes(batch).sum(0)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(n)), pa.int32()), "n": n})

    return homes.mapInArrow(count, "cell int, n long")


def _visits(
    homes: DataFrame, goes: _Reach, mine: np.ndarray, theirs: np.ndarray, vectors: str
) -> DataFrame:
    """Rows (cell, mine, theirs, member, id, n, v): who meets whom.

    A cell's members are cut into ``mine`` blocks and its visitors (members among them) into
    ``theirs``; each pair of blocks is a group, so a crowded cell is many groups of bounded size.
    """

    def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row repeated as often as its count, and the number of the repetition."""
        row = np.repeat(np.arange(len(counts)), counts)
        return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ids, home = batch["id"].to_numpy(), batch["home"].to_numpy()
            mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            mixed = mixed.astype(np.int64)
            row, cell = np.nonzero(goes(batch))
            at, block = spread(mine[cell])
            host, other = spread(theirs[home])
            take = np.concatenate([row[at], host])
            columns = {
                "cell": np.concatenate([cell[at], home[host]]),
                "mine": np.concatenate([block, mixed[host] % mine[home[host]]]),
                "theirs": np.concatenate([mixed[row[at]] % theirs[cell[at]], other]),
                "member": np.repeat([False, True], [len(at), len(host)]),
            }
            for low in range(0, len(take), 20_000):
                cut = slice(low, low + 20_000)
                part = {k: c[cut].astype(np.int32) for k, c in columns.items() if k != "member"}
                rows = {c: batch[c].take(pa.array(take[cut])) for c in ("id", "n", "v")}
                yield pa.RecordBatch.from_pydict(part | {"member": columns["member"][cut]} | rows)

    return homes.mapInArrow(
        visit, f"cell int, mine int, theirs int, member boolean, id long, n long, v {vectors}"
    )


def _meet(cosine: float):
    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        member = table["member"].to_numpy()
        ids, n = table["id"].to_numpy(), table["n"].to_numpy()
        units = _units(table["v"].combine_chunks())
        a, b = np.flatnonzero(member), np.flatnonzero(~member)
        links = np.zeros(len(a), np.int64)
        known, place = np.unique(ids, return_inverse=True)  # in order, so least place is least id
        label = np.arange(len(known))
        for low in range(0, len(a), 256):
            part = a[low : low + 256]
            near = units[part] @ units[b].T >= cosine
            near &= ids[part][:, None] != ids[b]
            links[low : low + 256] = near @ n[b]
            for i in np.flatnonzero(near.any(1)):
                linked = np.append(place[b[near[i]]], place[part[i]])
                labels = np.unique(label[linked])
                if len(labels) > 1:
                    label[np.isin(label, labels)] = labels[0]
        tree = np.flatnonzero(label != np.arange(len(known)))
        other = [None] * len(a) + known[label[tree]].tolist()
        return pa.table(
            {
                "id": np.concatenate([ids[a], known[tree]]),
                "links": np.concatenate([links, np.zeros(len(tree), np.int64)]),
                "other": pa.array(other, pa.int64()),
            }
        )

    return meet


def op3_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_join(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
