"""Near duplicates by one-permutation MinHash, and exact links between them.

A set's signature has one bin per slice of the hash range and keeps a byte of the least hash in
it; an empty bin borrows from a full one chosen by the bin's own permutation (optimal
densification), so equal positions of two signatures still agree as often as the sets overlap.
Bands of bins are buckets. Every bucket is a star around its least document, never all pairs.

Stars only gather families, inside which every link is found on full sets. As one minus the
similarity is a metric, members of a bucket that are far from its centre can only be linked
with each other or with those at middle distance, so just these meet once more without it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm.common import documents, stored
from ranktrail.llm.components import connected_components
from ranktrail.llm.shingles import shingle_sets
from ranktrail.llm.textbytes import mixed

BINS = 256
ROWS = 6  # bins of a band
BANDS = BINS // ROWS
PERCENT = 85  # a link: 100 * intersection >= PERCENT * union
SURE = 0.70  # least agreement of signatures of linked sets: six deviations below 0.85
# Linked sets differ by at most 0.15 in their similarity to a centre; the rest of the gap between
# these two is four deviations of the estimates.
ATTACHED = 0.40  # agreement with a centre from which on a member is in its family
APART = 0.72  # agreement below which a member may have links that the centre does not show
LOCAL = 2_048  # members of a bucket that one task compares
TARGETS = 2_000_000  # shingles of a block that stays in place, and of one that is compared with it
QUERIES = 1_000_000

TARGET, QUERY = 1, 2  # roles in a block
_order = np.random.Generator(np.random.PCG64(7))
_CHOICE = np.array([_order.permutation(BINS) for _ in range(BINS)])  # bins to borrow from
_RANK = np.argsort(_CHOICE, axis=1)
_SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, sig binary"


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A byte per bin of every sorted set; rows of empty sets are 0."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    bins = (hashes >> np.uint64(56)).astype(np.int64)
    first = np.ones(len(hashes), bool)
    first[1:] = (bins[1:] != bins[:-1]) | (row[1:] != row[:-1])
    full = np.zeros((n, BINS), bool)
    byte = np.zeros((n, BINS), np.uint8)
    full[row[first], bins[first]] = True
    byte[row[first], bins[first]] = mixed(hashes[first]).astype(np.uint8)
    filled = full.sum(1)
    for r in np.flatnonzero((filled > 0) & (filled < 48)):
        have = np.flatnonzero(full[r])
        byte[r] = np.where(full[r], byte[r], byte[r][have[_RANK[:, have].argmin(1)]])
    wide = np.flatnonzero((filled >= 48) & (filled < BINS))
    own, open_ = byte[wide], ~full[wide]
    out, source = own.copy(), full[wide]
    for t in range(BINS):
        left = np.flatnonzero(open_.any(1))
        if not len(left):
            break
        fits = open_[left] & source[left][:, _CHOICE[:, t]]
        out[left] = np.where(fits, own[left][:, _CHOICE[:, t]], out[left])
        open_[left] &= ~fits
    byte[wide] = out
    return byte


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, hashes, bounds in shingle_sets(batch["text"]):
            n = np.diff(bounds)
            byte = signatures(hashes, bounds)
            digest = []
            for salt in (3, 5):
                sums = np.zeros(len(hashes) + 1, np.uint64)
                np.cumsum(mixed(hashes * np.uint64(2 * salt + 1) + np.uint64(salt)), out=sums[1:])
                digest.append((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"][first : first + len(n)],
                    "n_shingles": n.astype(np.int64),
                    "d1": digest[0],
                    "d2": digest[1],
                    "sig": pa.array([b.tobytes() for b in byte], pa.binary()),
                }
            )


def _band(b: int) -> Column:
    value = F.conv(F.hex(F.substring("sig", b * ROWS + 1, ROWS)), 16, 10).cast("long")
    return F.shiftleft(value, 8).bitwiseOR(F.lit(b))


def _agreement(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b, est): the share of equal bins."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x, y = (
                    np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, BINS)
                    for c in ("x", "y")
                )
                est = (x == y).mean(1)
                yield pa.RecordBatch.from_pydict({"a": batch["a"], "b": batch["b"], "est": est})

    joined = pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("x")), "a").join(
        sigs.select(F.col("id").alias("b"), F.col("sig").alias("y")), "b"
    )
    return joined.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long, est double")


def _near_in_bucket(table: pa.Table) -> pa.Table:
    """Tree edges of the members whose signatures agree enough for a link."""
    ids = table["id"].to_numpy()
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(-1, BINS)
    label = np.arange(len(ids))
    for i in range(len(ids) - 1):
        near = np.flatnonzero((sig[i + 1 :] == sig[i]).mean(1) >= SURE) + i + 1
        labels = np.unique(label[np.append(near, i)])
        if len(labels) > 1:
            label[np.isin(label, labels)] = labels[0]
    tree = np.flatnonzero(label != np.arange(len(ids)))
    return pa.table({"a": ids[label[tree]], "b": ids[tree]})


def _families(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Family edges (a, b), and the star pairs (a, b, est) that were compared."""
    sigs = classes.select("id", "sig")
    keys = F.explode(F.array(*[_band(b) for b in range(BANDS)])).alias("key")
    rows = classes.select("id", keys)
    edges, stars, step = [], [], 0
    while True:
        centres = rows.groupBy("key").agg(F.min("id").alias("c"), F.count("*").alias("n"))
        # a join of two plain tables can split a busy bucket
        centres = stored(centres.filter(F.col("n") > 1), f"centres-{step}")
        shared = rows.join(centres, "key").filter(F.col("id") != F.col("c"))
        if step:
            local = rows.join(centres.filter(F.col("n") <= LOCAL).select("key"), "key")
            local = local.join(sigs, "id").select("key", "id", "sig")
            met = local.groupBy("key").applyInArrow(_near_in_bucket, "a long, b long")
            edges.append(stored(met.distinct(), f"bucket-edges-{step}"))
            shared = shared.filter(F.col("n") > LOCAL)
        shared = stored(shared.select("key", "id", "c"), f"buckets-{step}")
        if shared.isEmpty():
            break
        pairs = shared.select(F.col("c").alias("a"), F.col("id").alias("b")).distinct()
        stars.append(stored(_agreement(pairs, sigs), f"stars-{step}"))
        edges.append(stars[-1].filter(F.col("est") >= ATTACHED).select("a", "b"))
        apart = stars[-1].filter(F.col("est") < APART)
        rows = shared.join(
            apart, (F.col("c") == F.col("a")) & (F.col("id") == F.col("b"))
        ).select("id", "key")
        step += 1
    none = stored(sigs.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0), "no-edges")
    all_edges = reduce(DataFrame.unionByName, edges, none)
    all_stars = reduce(DataFrame.unionByName, stars, none.withColumn("est", F.lit(0.0)))
    return all_edges.filter(F.col("a") != F.col("b")), all_stars


def _sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(id, s): the whole set of every family member, from its text."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, bounds in shingle_sets(batch["text"]):
                values = pa.array(hashes.view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
                ids = batch["id"][first : first + len(lists)]
                yield pa.RecordBatch.from_pydict({"id": ids, "s": lists})

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    own = texts.join(members.select("id"), "id").dropDuplicates(["id"])
    return own.mapInArrow(gather, "id long, s array<long>")


def _exact(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are links on full sets."""
    one = sets.select(F.col("id").alias("a"), F.col("s").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("s").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common
    return pairs.join(one, "a").join(two, "b").filter(100 * common >= percent * union).select("a", "b")


def _links_in_block(percent: int):
    def links(table: pa.Table) -> pa.Table:
        """Links between queries and targets of a block that join different components."""
        table = table.combine_chunks()
        ids, comps = table["id"].to_numpy(), table["component"].to_numpy()
        role = table["role"].to_numpy()
        lists = table["s"].combine_chunks()
        edges = lists.offsets.to_numpy()
        flat = lists.values.to_numpy()
        size = np.diff(edges)
        q, t = np.flatnonzero(role & QUERY), np.flatnonzero(role & TARGET)
        target = np.repeat(np.arange(len(t)), size[t])
        hashes = np.concatenate([flat[edges[i] : edges[i + 1]] for i in t])
        order = np.argsort(hashes, kind="stable")
        hashes, target = hashes[order], target[order]
        _, label = np.unique(comps, return_inverse=True)
        found: list[tuple[int, int]] = []
        for i in q:
            own = flat[edges[i] : edges[i + 1]]
            low = np.searchsorted(hashes, own, "left")
            n = np.searchsorted(hashes, own, "right") - low
            at = np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)
            common = np.bincount(target[at], minlength=len(t))
            union = size[i] + size[t] - common
            linked = t[100 * common >= percent * union]
            for j in linked[label[linked] != label[i]]:
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
                    found.append((int(ids[i]), int(ids[j])))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return links


def _blocks(light: DataFrame) -> DataFrame:
    """(id, family, component, qb, tb, role): which members meet in which block.

    Families in one component need no more. In the others, the members outside the main component
    are compared with all members.
    """
    parts = light.groupBy("family", "component").agg(F.sum("n").alias("k"))
    family = parts.groupBy("family").agg(
        F.sum("k").alias("m"), F.max(F.struct("k", "component")).alias("main")
    )
    outside = F.col("m") - F.col("main.k")
    family = family.filter(outside > 0).select(
        "family",
        F.col("main.component").alias("main"),
        F.ceil(outside / QUERIES).cast("int").alias("nq"),
        F.ceil(F.col("m") / TARGETS).cast("int").alias("nt"),
    )
    family = stored(family, "open-families")
    salt = F.xxhash64("id")
    rows = light.join(family, "family").withColumns(
        {
            "q": F.pmod(salt, F.col("nq")).cast("int"),
            "t": F.pmod(salt, F.col("nt")).cast("int"),
            "out": F.col("component") != F.col("main"),
        }
    )
    columns = ["id", "family", "component"]
    both = F.when(F.col("out") & (F.col("qb") == F.col("q")), TARGET | QUERY).otherwise(TARGET)
    targets = rows.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).select(
        *columns, "qb", F.col("t").alias("tb"), both.alias("role")
    )
    queries = (
        rows.filter("out")
        .withColumn("tb", F.explode(F.sequence(F.lit(0), F.col("nt") - 1)))
        .filter(F.col("tb") != F.col("t"))
        .select(*columns, F.col("q").alias("qb"), "tb", F.lit(QUERY).alias("role"))
    )
    return targets.unionByName(queries)


def _family_links(
    docs: DataFrame, classes: DataFrame, edges: DataFrame, stars: DataFrame, percent: int
) -> DataFrame:
    """Links (a, b) that connect what is connected, tested on full sets.

    In families too large for one block the links of their stars come first, which leaves few
    members outside a main component.
    """
    members = connected_components(edges, "families").select(
        F.col("node").alias("id"), F.col("component").alias("family")
    )
    members = members.join(classes.select("id", "n"), "id")
    sets = stored(_sets(docs, members), "family-sets")
    large = members.groupBy("family").agg(F.sum("n").alias("m")).filter(F.col("m") > TARGETS)
    large = stored(large, "large-families")
    centres = members.join(large, "family").select(F.col("id").alias("a"))
    likely = stars.filter(F.col("est") >= SURE).join(centres, "a", "semi").select("a", "b")
    first = stored(_exact(likely, sets, percent), "star-links")
    known = connected_components(first, "star-components").withColumnRenamed("node", "id")
    component = F.coalesce("component", "id").alias("component")
    light = members.join(known, "id", "left").select("id", "family", "n", component)
    blocks = _blocks(stored(light, "family-members")).join(sets, "id")
    second = blocks.groupBy("family", "qb", "tb").applyInArrow(
        _links_in_block(percent), "a long, b long"
    )
    return first.unionByName(stored(second, "family-links"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of five-word shingles (A-Z lowered; a text of fewer words
    is one shingle) have 100 * intersection >= percent * union; percent is at least 85. The
    component is the smallest doc_id reachable, and ``kept`` marks it. Null and empty texts have
    no shingles and no links. Rows with equal sets, repeated rows among them, are one node. A null
    doc_id stays null, unlinked and not kept. Other columns are ignored. An empty table gives no
    rows. A doc_id names one text.
    """
    signed = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sign, _SIGNED)
    signed = stored(signed, "signatures")
    usable = signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = stored(
        usable.groupBy("d1", "d2").agg(
            F.min("doc_id").alias("id"),
            F.any_value("sig").alias("sig"),
            F.any_value("n_shingles").alias("n"),
        ),
        "classes",
    )
    links = _family_links(docs, classes, *_families(classes), percent)
    found = connected_components(links, "duplicates").withColumnRenamed("node", "id")
    named = classes.join(found, "id", "left").select(
        "d1", "d2", F.coalesce("component", "id").alias("component_id")
    )
    ids = usable.join(named, ["d1", "d2"]).select("doc_id", "n_shingles", "component_id")
    rest = signed.filter((F.col("n_shingles") == 0) | F.col("doc_id").isNull()).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return ids.unionByName(rest).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def distinct_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents of which one stays for every group; a null doc_id is never dropped."""
    kept = near_duplicates(docs, percent).filter("kept").select("doc_id")
    one = docs.join(kept, "doc_id", "semi").dropDuplicates(["doc_id"])
    return one.select(docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
