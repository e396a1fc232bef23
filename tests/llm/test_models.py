from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stakeflow.llm import language_id, lattice, lm_scoring, quality_pu
from tests.llm.helpers import ODD, SMALL, odd_docs, words


@pytest.fixture(scope="module")
def made():
    return lattice.tables(lattice.read_model())


def test_marginal_is_the_sum_over_all_segmentations(made):
    pieces = lattice.piece_bytes(made["model"])[0]
    at = {p: i for i, p in enumerate(pieces)}
    logp = np.log(np.random.default_rng(3).dirichlet(np.ones(len(pieces)), 2).T)
    texts = [w.encode() for w in ("a", "hello", "größe", "漢字漢字", "x" * 90, "überstraßenbahn")]

    def ways(rest: bytes) -> float:  # every segmentation, one by one
        return 1.0 if not rest else sum(
            math.exp(logp[at[rest[:n]], 0]) * ways(rest[n:]) for n in range(1, 17) if n <= len(rest) and rest[:n] in at
        )

    end = np.cumsum([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    found = lattice.Lattice(made).marginals(data, end - [len(t) for t in texts], end, logp)[:, 0]
    for text, score in zip(texts, found):
        if len(text) < 14:
            assert score == pytest.approx(math.log(ways(b" " + text)), rel=1e-9)
    assert np.isfinite(found).all()


def test_lm_scores_equal_plain_counting(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows}
    count = Counter(w for r in rows if not held[r["doc_id"]] for w in [*words(r["text"]), "\n"])
    n, v = sum(count.values()), len(count)
    found = lm_scoring.score(docs, ~language_id.held_out(F.col("doc_id"), 10, 0)).collect()
    assert len(found) == len(rows)
    texts = {r["doc_id"]: [*words(r["text"]), "\n"] for r in rows}
    for r in found:
        own = texts[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in count for w in own), n)
        assert r["base_score"] == pytest.approx(base) and -1e7 < r["score"] < 0


def test_rare_and_broadcast_words_score_alike(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the cat {'dog ' * (i % 3)} w{i}", "x") for i in range(40)], "doc_id long, text string, word string")
    found = []
    for share in (1, 1 << 17):
        monkeypatch.setattr(lm_scoring, "SHARE", share)
        found.append(sorted((r["doc_id"], r["n_known"], round(r["base_score"], 9), round(r["score"], 9)) for r in lm_scoring.score(docs, F.col("doc_id") % 2 == 0).collect()))
    assert found[0] == found[1]


def test_lm_odd_rows(spark):
    found = {r["doc_id"]: r for r in lm_scoring.score(odd_docs(spark), F.col("doc_id").isNotNull()).collect()}
    assert found[1]["n_tokens"] == found[2]["n_tokens"] == found[3]["n_tokens"] == 1 and None in found
    nothing = lm_scoring.score(odd_docs(spark), F.lit(False)).collect()
    assert len(nothing) == len(ODD) and {r["n_known"] for r in nothing} == {0}
    assert lm_scoring.score(odd_docs(spark, []), F.lit(True)).count() == 0


def test_languages_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.digest(language_id.identify(docs, keep=["doc_id"])).join(docs.select("doc_id", "lang"), "doc_id")
    right = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_language_odd_rows(spark):
    found = {r["doc_id"]: r for r in language_id.identify(odd_docs(spark), keep=["doc_id", "n_chars"]).collect()}
    assert all((found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0) for i in (1, 2, 3, 4))
    assert {found[i]["lang_pred"] for i in (5, 7, 8, 9)} <= {"en", "de"} and found[7]["score"] <= 1
    unlabelled = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled, keep=["doc_id"]).collect()} == {"und"}
    assert language_id.identify(odd_docs(spark, []), keep=["doc_id"]).count() == 0


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    train = ~language_id.held_out(F.col("doc_id"), 3, 1)
    found = quality_pu.digest(quality_pu.score(docs, labels, train)).join(labels, "doc_id").filter("held_out")
    right = found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95


def test_risk_correction_recovers_negatives():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(2, 1, (3000, 3)), rng.normal(-2, 1, (3000, 3))
    model = quality_pu.fit(good[:1000], np.concatenate([good[1000:2000], bad[:1000]]), 0.5)
    assert (model.scores(good[2000:]) > 0.5).mean() > 0.95 and (model.scores(bad[2000:]) < 0.5).mean() > 0.95


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (6, 0), (7, 1), (7, 0), (9, None), (None, 1), (99, 1)], "doc_id long, quality int")
    found = quality_pu.score(odd_docs(spark), labels, F.lit(True)).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    none = quality_pu.score(odd_docs(spark), labels.limit(0), F.lit(True)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_pu.score(odd_docs(spark, []), labels, F.lit(True)).count() == 0
