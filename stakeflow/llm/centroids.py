"""Centroid clustering of integer vectors, nearest centroids found through a vantage-point tree.

Each round the driver builds a vantage-point tree over the current centroids (k of them, so the tree is bounded by k,
never by the data) and broadcasts it. Every partition then searches it for all its vectors at once: a best-first
branch and bound in which each vector pops its own lowest-bound node, measures the exact integer squared distance to
the node's centroid and pushes the node's children with triangle-inequality bounds. A subtree is left only when its
bound exceeds the best distance found, so equal distances are still visited (inclusive pruning radius) and a tie goes
to the smaller centroid number. The same pass sums the vectors of each centroid, so a round is one scan plus a
group-by of at most k rows per task: a centroid holding a third of all vectors costs nothing extra.

Integer components keep sums and distances exact: with |x| <= 64 * |component| they fit in 64 bits for any table
with fewer than 2**40 vectors.

Cases: vectors that are NULL, of another length, or hold a NULL or non-finite component take no part; a NULL vec_id
takes part but cannot seed a centroid; repeated rows count once each; fewer kept vectors than k give fewer centroids;
an empty centroid keeps its place; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stakeflow.llm.scratch import written

# Fixed values of the clustering.
DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED_PREFIX = "1:"


class Tree(NamedTuple):
    """Node i holds centroid ``point[i]``; its inside child holds points within ``radius[i]``, its outside child the rest."""

    point: np.ndarray
    radius: np.ndarray
    inside: np.ndarray
    outside: np.ndarray


def build(centroids: np.ndarray) -> Tree:
    """A vantage-point tree over the rows of ``centroids``: the smallest number of a subset is its vantage point,
    the median of its distances to the others the radius."""
    k = len(centroids)
    point, radius = np.zeros(k, np.int64), np.zeros(k)
    inside, outside = np.full(k, -1), np.full(k, -1)
    nodes = 0

    def make(members: list[int]) -> int:
        nonlocal nodes
        if not members:
            return -1
        me, rest = members[0], members[1:]
        node = nodes
        nodes += 1
        point[node] = me
        if rest:
            far = np.sqrt(((centroids[rest] - centroids[me]) ** 2).sum(axis=1).astype(np.float64))
            radius[node] = float(np.median(far))
            inside[node] = make([m for m, d in zip(rest, far) if d <= radius[node]])
            outside[node] = make([m for m, d in zip(rest, far) if d > radius[node]])
        return node

    make(list(range(k)))
    return Tree(point, radius, inside, outside)


def nearest(x: np.ndarray, centroids: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(centroid number, squared distance) of the nearest centroid of each row of ``x``; ties to the smaller number."""
    q, nodes = len(x), len(tree.point)
    best = np.full(q, np.iinfo(np.int64).max, np.int64)
    label = np.full(q, -1, np.int64)
    if not q or not nodes:
        return label, best
    # The frontier of each vector: lower bound per node, infinite where the node is not waiting.
    bound = np.full((q, nodes), np.inf)
    bound[:, 0] = 0.0
    active = np.arange(q)
    while len(active):
        node = bound[active].argmin(axis=1)
        low = bound[active, node]
        reach = np.sqrt(best[active].astype(np.float64))
        go = low <= reach * (1 + 1e-12) + 1e-9
        active, node, low = active[go], node[go], low[go]
        if not len(active):
            break
        bound[active, node] = np.inf
        c = tree.point[node]
        gap = x[active] - centroids[c]
        d2 = np.einsum("ij,ij->i", gap, gap)
        better = (d2 < best[active]) | ((d2 == best[active]) & (c < label[active]))
        best[active[better]], label[active[better]] = d2[better], c[better]
        d = np.sqrt(d2.astype(np.float64))
        r = tree.radius[node]
        for child, edge in ((tree.inside[node], d - r), (tree.outside[node], r - d)):
            has = child >= 0
            bound[active[has], child[has]] = np.maximum(low[has], np.maximum(0.0, edge[has]))
    return label, best


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), DIMENSIONS)


def _sum_batches(shared):
    """Per batch and centroid: count and componentwise sums of the vectors it is nearest to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, tree = shared.value[0], Tree(*shared.value[1])
        k = len(centroids)
        for batch in batches:
            x = _matrix(batch.column(0))
            label, _ = nearest(x, centroids, tree)
            n = np.bincount(label, minlength=k)
            sums = np.zeros((k, DIMENSIONS), np.int64)
            np.add.at(sums, label, x)
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(n[used].astype(np.int64)),
                 *(pa.array(sums[used, j]) for j in range(DIMENSIONS))],
                ["cluster", "n", *(f"s{j}" for j in range(DIMENSIONS))],
            )

    return run


def _assign_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, tree = shared.value[0], Tree(*shared.value[1])
        for batch in batches:
            label, best = nearest(_matrix(batch.column(1)), centroids, tree)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(label.astype(np.int32)), pa.array(best)], ["vec_id", "cluster", "distance"]
            )

    return run


def integer_vectors(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, v): vectors of ``DIMENSIONS`` finite components, each turned into floor(SCALE * x) with x as double."""
    x = F.col(column)
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    return embeddings.filter(x.isNotNull() & (F.size(x) == DIMENSIONS) & whole).select(
        F.col(key).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long")).alias("v"),
    )


def seeds(vectors: DataFrame, k: int = CLUSTERS) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``SEED_PREFIX`` and vec_id, in that order (ties by components)."""
    order = F.sha2(F.concat(F.lit(SEED_PREFIX), F.col("vec_id").cast("string")), 256)
    rows = vectors.filter(F.col("vec_id").isNotNull()).select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), DIMENSIONS)


def cluster(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector after ``rounds`` updates, final centroids)."""
    vectors = written(integer_vectors(embeddings), "vectors")
    spark = vectors.sparkSession
    centroids = seeds(vectors, k)
    sums = ", ".join(["cluster int, n long", *(f"s{j} long" for j in range(DIMENSIONS))])
    for _ in range(rounds):
        if not len(centroids):
            break
        shared = spark.sparkContext.broadcast((centroids, tuple(build(centroids))))
        totals = vectors.select("v").mapInArrow(_sum_batches(shared), sums).groupBy("cluster").agg(
            *(F.sum(c).alias(c) for c in ["n", *(f"s{j}" for j in range(DIMENSIONS))])
        ).collect()
        moved = centroids.copy()
        for r in totals:
            moved[r["cluster"]] = np.floor_divide(np.array([r[f"s{j}"] for j in range(DIMENSIONS)], np.int64), r["n"])
        centroids = moved
    shared = spark.sparkContext.broadcast((centroids, tuple(build(centroids))))
    assigned = vectors.mapInArrow(_assign_batches(shared), "vec_id long, cluster int, distance long")
    return assigned, centroids


def _centroid_hash(v: Column) -> Column:
    return F.sha2(F.concat_ws(",", F.transform(v, lambda c: c.cast("string"))), 256)


def summary(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Sums per cluster are taken with partial aggregation (at most k rows a task) and joined back as a table of at most k rows.
    """
    spark = assigned.sparkSession
    by_cluster = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    known = spark.createDataFrame([(i, [int(c) for c in row]) for i, row in enumerate(centroids)], "cluster int, v array<long>")
    per_cluster = by_cluster.join(known, "cluster").select(
        "cluster", "cluster_inertia", F.sum("cluster_inertia").over(Window.partitionBy()).alias("inertia"),
        _centroid_hash(F.col("v")).alias("centroid_sha256"),
    )
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
