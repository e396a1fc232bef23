"""Exact top-k by inner product over integer vectors, with norm buckets.

Vectors are grouped by length. For a query, a bucket's best possible product is the query's length times
the largest length of the bucket, so the product threshold becomes a cosine threshold local to the
bucket. If that is above 1 the bucket holds nothing. If it is high, few coordinates of the unit query carry the
product, and a bound from those coordinates prunes candidates (coordinate pruning); if it is
low, only the candidate's own length is used (length pruning). Whatever remains has its product
computed exactly, in integers.

Queries are taken in blocks and candidates in partitions; a block and a partition meet once, and each
gives k rows per query. Nothing else is kept, so memory is bounded by the two blocks.

Cases: a vector that is NULL, empty or holds a NULL or non-finite component takes no part; vectors of
another dimension than a query's are no candidates for it; rows that share a vec_id are one
vector if they are equal and otherwise each take part; an all-zero vector scores 0 with everything; ties go to the
smaller vec_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from stakeflow.llm.scratch import written

BUCKET = 256  # candidates of neighbouring length
BLOCK = 16384  # queries that are broadcast together
STEEP = 0.6  # local cosine threshold from which coordinates prune
ROWS = 1024  # queries worked on at a time
FOCUS = 8  # coordinates of a query in the coordinate bound
MATCH = "query_id long, vec_id long, score long"


def whole_vectors(rows: DataFrame, vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component as long; NULL where the vector takes no part."""
    doubles = vector.cast("array<double>")
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine & (F.size(doubles) > 0), F.transform(doubles, lambda x: F.floor(x * F.lit(scale)).cast("long")))


class Best:
    """The k best different candidates so far of each query, by score and then by id.

    An id with an equal score is held once, however many batches repeat its row.
    """

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def take(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        merged = np.concatenate([self.score[rows], score], axis=1)
        every = np.concatenate([self.id[rows], np.broadcast_to(ids, score.shape)], axis=1)
        keep = np.lexsort((every, -merged), axis=1)
        merged, every = np.take_along_axis(merged, keep, 1), np.take_along_axis(every, keep, 1)
        again = np.zeros(merged.shape, bool)
        again[:, 1:] = (merged[:, 1:] == merged[:, :-1]) & (every[:, 1:] == every[:, :-1])
        if again.any():
            merged[again], every[again] = -np.inf, np.iinfo(np.int64).max
            keep = np.argsort(again, axis=1, kind="stable")[:, :k]
            merged, every = np.take_along_axis(merged, keep, 1), np.take_along_axis(every, keep, 1)
        self.score[rows], self.id[rows] = merged[:, :k], every[:, :k]


def improve(best: Best, q_id: np.ndarray, q: np.ndarray, c_id: np.ndarray, c: np.ndarray) -> None:
    """Hold a batch of different candidates against the queries, by norm buckets from the longest."""
    length = np.sqrt((c.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    c, c_id, length = c[order], c_id[order], length[order]
    q_length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    exact = np.float64 if (q_length.max(initial=0) * length.max(initial=0)) < 2**52 else np.int64
    qs, cs = q.astype(exact), c.astype(exact)
    # The query's largest coordinates, and the length of what they leave.
    focus = np.argsort(-np.abs(q), axis=1)[:, :FOCUS]
    rest = np.sqrt(np.maximum(0, q_length**2 - (np.take_along_axis(q, focus, 1).astype(np.float64) ** 2).sum(axis=1)))
    for a in range(0, len(c), BUCKET):
        part, own = slice(a, a + BUCKET), c_id[a:a + BUCKET]
        longest = length[a]
        kth = best.score[:, -1]
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(np.isneginf(kth), -np.inf, kth / (q_length * longest))
        live = np.flatnonzero(~(kth > q_length * longest * (1 + 1e-12)))
        if not len(live):
            continue
        steep = live[cosine[live] >= STEEP]
        flat = live[~(cosine[live] >= STEEP)]
        parts = [(x[i:i + ROWS], x is steep) for x in (steep, flat) for i in range(0, len(x), ROWS)]
        for rows, by_coordinate in parts:
            bound = q_length[rows, None] * length[None, part]
            if by_coordinate:
                at = c[part].astype(np.float64)[:, focus[rows]]
                near = np.einsum("crf,rf->rc", at, np.take_along_axis(q, focus, 1)[rows].astype(np.float64))
                held = (at * at).sum(axis=2).T
                left = np.sqrt(np.maximum(0, length[None, part] ** 2 - held))
                bound = near + rest[rows, None] * left
            slack = 1e-9 * (1 + np.abs(bound))
            open_ = bound + slack >= kth[rows, None]
            some = np.flatnonzero(open_.any(axis=0))
            if not len(some):
                continue
            score = (qs[rows] @ cs[part][some].T).astype(np.float64)
            score[(q_id[rows, None] == own[None, some]) | ~open_[:, some]] = -np.inf
            # Only queries and candidates that change something are sorted in.
            hit = (score >= kth[rows, None]) & ~np.isneginf(score)
            better, useful = hit.any(axis=1), hit.any(axis=0)
            if better.any():
                best.take(rows[better], score[better][:, useful], own[some][useful])


def _different(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each repeated (id, vector) row."""
    if len(np.unique(ids)) == len(ids):
        return ids, vectors
    rows = np.unique(np.column_stack([ids, vectors]), axis=0)
    return rows[:, 0], rows[:, 1:]


def _search(shared, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vectors = shared.value
        width = np.array([len(x) for x in vectors])
        asked = {n: (ids[width == n], np.stack([x for x in vectors if len(x) == n])) for n in np.unique(width)}
        best = {n: Best(len(q_id), k) for n, (q_id, _) in asked.items()}
        for batch in batches:
            sizes = batch["v"].map(len).to_numpy()
            for n in set(asked) & set(sizes):
                own = batch[sizes == n]
                c_id, c = _different(own["vec_id"].to_numpy(), np.stack(own["v"].to_numpy()))
                improve(best[n], *asked[n], c_id, c)
        for n, (q_id, _) in asked.items():
            i, j = np.nonzero(~np.isneginf(best[n].score))
            yield pd.DataFrame({
                "query_id": q_id[i], "vec_id": best[n].id[i, j], "score": best[n].score[i, j].astype(np.int64),
            })

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest products, from (vec_id, v) rows on both sides.

    A block of queries is broadcast: at most ``block`` vectors, whatever the number of queries. Blocks
    follow each other, each over all candidates.
    """
    spark = candidates.sparkSession
    asked = written(
        queries.select("vec_id", "v").dropDuplicates().withColumn("h", F.xxhash64("v")), "queries"
    )
    given, parts, rest = candidates.select("vec_id", "v"), [], asked
    while rows := rest.orderBy("vec_id", "h").limit(block).collect():
        shared = spark.sparkContext.broadcast(
            (np.array([r["vec_id"] for r in rows]), [np.array(r["v"], np.int64) for r in rows])
        )
        parts.append(given.mapInPandas(_search(shared, k), MATCH))
        last = rows[-1]
        rest = asked.filter(
            (F.col("vec_id") > last["vec_id"]) | (F.col("vec_id") == last["vec_id"]) & (F.col("h") > last["h"])
        )
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order).cast("int")).filter(
        F.col("rank") <= k
    ).select("query_id", "rank", "vec_id", "score")


def search(rows: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0) -> DataFrame:
    """Rows whose vec_id is divisible by ``every``, each against all other rows."""
    whole = rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole_vectors(rows, F.col("embedding"), scale).alias("v"))
    whole = whole.filter("vec_id IS NOT NULL AND v IS NOT NULL")
    return top_k(whole.filter(F.col("vec_id") % every == 0), whole, k)
