from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stakeflow.llm import centroids


@pytest.mark.parametrize("seed", range(4))
def test_tree_search_equals_brute_force_with_ties(seed):
    rng = np.random.default_rng(seed)
    c = rng.integers(-2, 3, (16, 8))
    c[5] = c[2]  # equal centroids: the smaller number wins
    x = np.concatenate([rng.integers(-3, 4, (3000, 8)), c])
    label, best = centroids.nearest(x, c, centroids.build(c))
    d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (best == d.min(axis=1)).all()
    assert (label == d.argmin(axis=1)).all()  # argmin takes the first of equal values


def test_search_with_one_and_no_centroid():
    x = np.arange(12).reshape(3, 4)
    assert centroids.nearest(x, x[:1], centroids.build(x[:1]))[0].tolist() == [0, 0, 0]
    assert centroids.nearest(x, x[:0], centroids.build(x[:0]))[0].tolist() == [-1, -1, -1]


def brute(rows, k=centroids.CLUSTERS, rounds=centroids.ROUNDS, dim=centroids.DIMENSIONS):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    seeded = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in seeded[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for n in range(len(cents)):
            mine = [v for (_, v), (_, m) in zip(kept, got) if m == n]
            if mine:
                cents[n] = [sum(col) // len(mine) for col in zip(*mine)]
    got = assign()
    per = {}
    for d, n in got:
        per[n] = per.get(n, 0) + d
    return sorted((
        (i, n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest())
        for (i, _), (d, n) in zip(kept, got)
    ), key=ordered)


def ordered(row):
    return (row[0] is None, row[0] or 0, row[1:])


def test_clusters_equal_brute_force_on_odd_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 64)]) for i in range(40)]
    rows += [
        (100, None), (101, [0.5] * 63), (102, [0.1] * 63 + [None]), (103, [float("nan")] * 64), (104, [float("inf")] + [0.0] * 63),
        (None, [0.2] * 64), (3, rows[3][1]), (105, [-0.999] * 64), (106, [0.0] * 64), (107, [0.0] * 64),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {"cluster": F.lit(1), "v": F.lit("x"), "distance": F.lit(2.0)}
    )
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assigned, final = centroids.cluster(df)
    found = sorted((tuple(r) for r in centroids.summary(assigned, final).collect()), key=ordered)
    assert found == brute(as_float)


def test_fewer_vectors_than_centroids_and_empty_table(spark):
    rows = [(i, [0.01 * i] * 64) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assigned, final = centroids.cluster(df)
    assert len(final) == 5
    assert sorted((tuple(r) for r in centroids.summary(assigned, final).collect()), key=ordered) == brute(
        [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    )
    assigned, final = centroids.cluster(df.limit(0))
    assert centroids.summary(assigned, final).count() == 0
