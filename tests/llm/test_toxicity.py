from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stakeflow.llm import language_id, queries, toxicity
from tests.llm.helpers import ODD, odd_docs


def brute_best(s) -> float:
    return max([0.0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)])


def brute_maximal(s) -> list:
    """Maximal segments by their definition: peel off the best segment (the shortest of equal ones, which starts and
    ends with a positive score), recurse on both sides."""
    out = []

    def peel(a, b):
        best, where = 0.0, None
        for i in range(a, b):
            for j in range(i + 1, b + 1):
                v = sum(s[i:j])
                if v > best + 1e-12 and s[i] > 0 and s[j - 1] > 0:
                    best, where = v, (i, j)
        if where:
            out.append((where[0], where[1], best))
            peel(a, where[0])
            peel(where[1], b)

    peel(0, len(s))
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_segments_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    docs = [rng.normal(-0.5, 2, rng.integers(0, 14)) for _ in range(20)]  # no ties between segments
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    found = toxicity.best_segments(np.concatenate(docs), first)
    assert found == pytest.approx([brute_best(list(d)) for d in docs])
    for d in docs:
        mine = toxicity.maximal_segments(list(d))
        assert [(a, b) for a, b, _ in sorted(mine)] == [(a, b) for a, b, _ in brute_maximal(list(d))]


def test_falling_sums_take_linear_time():
    """Every positive word lies below all segments before it, which once cost a walk over all of them."""
    import time

    n = 200_000
    scores = np.where(np.arange(n) % 2 == 0, 1.0, -2.0)
    began = time.perf_counter()
    assert toxicity.maximal_segments(scores) == [(i, i + 1, 1.0) for i in range(0, n, 2)]
    assert toxicity.best_segments(scores, np.array([0, n // 2, n])).tolist() == [1.0, 1.0]
    assert time.perf_counter() - began < 20


def test_query_returns_its_segments(spark, tmp_path):
    calm, rude = "plain calm text of a quiet day " * 20, "idiot moron clown " * 6
    rows = [(i, calm + rude + calm, "en", "a", 1) for i in range(20)] + [(50 + i, calm + f"number {i}", "en", "b", 1) for i in range(20)]
    docs = odd_docs(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(
        [(r[0], 1, int(r[0] < 50)) for r in rows], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    found = {r["doc_id"]: r for r in queries.QUERIES["op11_toxic_segments"](spark, str(tmp_path)).collect()}
    assert {(r["n_passages"], r["passages"]) for i, r in found.items() if i < 50} == {(1, "140:158")}
    assert {(r["n_passages"], r["passages"]) for i, r in found.items() if i >= 50} == {(0, "")}
    model = toxicity.learn(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"), F.lit(True))
    spans = toxicity.passages(docs, model).collect()
    assert {(r["start"], r["end"]) for r in spans} == {(140, 158)} and len(spans) == 20


def test_scores_of_odd_rows(spark):
    rows = list(ODD) + [(30 + i, f"word{i} idiot moron clown " * 5, "en", "a", 1) for i in range(8)] + [
        (50 + i, f"plain calm text number {i} " * 5, "en", "b", 1) for i in range(8)
    ]
    docs = odd_docs(spark, rows)
    labels = spark.createDataFrame(
        [(30 + i, 1, 1) for i in range(8)] + [(50 + i, 1, 0) for i in range(8)] + [(1, None, None), (5, 1, 1), (5, 1, 0), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    ).withColumn("score", F.lit(0.5))
    model = toxicity.learn(docs, labels, F.lit(True))
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows)
    assert all(0 <= r["score"] <= 1 for r in found)
    by_id = {r["doc_id"]: r["score"] for r in found if r["doc_id"] is not None}
    assert min(by_id[30 + i] for i in range(8)) > max(by_id[50 + i] for i in range(8))
    spans = toxicity.passages(docs, model).collect()
    assert {r["doc_id"] for r in spans} >= {30 + i for i in range(8)}


def test_no_labels_gives_the_prior(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = toxicity.score(docs, toxicity.learn(docs, labels, F.lit(True))).collect()
    assert {r["score"] for r in found} == {0.5}
    assert toxicity.score(docs.limit(0), toxicity.learn(docs, labels, F.lit(True))).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"  # some hundred toxic training documents
    found = queries.QUERIES["op11_toxic_segments"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out AND toxic IS NOT NULL").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    caught = sum(r["predicted"] == 1 for r in rows if r["toxic"] == 1)
    assert right / len(rows) >= 0.9
    assert caught >= 0.8 * sum(r["toxic"] == 1 for r in rows)
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
