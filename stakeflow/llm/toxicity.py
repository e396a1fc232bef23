"""Toxic passages by maximum-scoring segments over word log-odds.

Each word (A-Z lower-cased, outer punctuation removed) falls into one of ``BUCKETS`` hash buckets. From labelled training
documents a bucket gets the log ratio of its smoothed probabilities in toxic and in clean text, each smoothed by a
Dirichlet prior centred on the background frequency of the bucket (``PRIOR`` pseudo-words spread by the background, plus
``FLOOR`` on every bucket that was seen). Buckets never seen in training score 0. Because the two smoothed distributions
each sum to one, the expected log ratio of a clean word is negative (minus a divergence). Scores are the log ratio less
its ``MARGIN`` quantile over clean training words, so that random rare words stay below 0; the Karlin-Altschul exponent
lambda of these scores is solved by bisection.

A document's maximal scoring segments are found in one linear pass over its words (Ruzzo-Tompa); its statistic S is the
score of the best of them. Under clean text, S of a document of n words follows an
extreme-value law, P(S >= x) ~ 1 - exp(-K n e^(-lambda x)); K is estimated by maximum likelihood over all clean training
documents, and -log E = lambda S - log(K n), compressed logarithmically, is turned into a probability by a logistic fit over all labelled training documents
(Newton steps, each one Spark aggregate). The training documents are scored out of fold (two folds by hash), so that the
fit sees scores like those of unseen documents. The segments whose E-value is at most ``SIGNIFICANT`` are a document's
toxic passages: ``score`` returns them beside the score, ``passages`` as one row each.

The model is a fixed number of buckets, so what is broadcast has a bound (``3 * BUCKETS`` float32, 24 MB) whatever the
size of the corpus; counts are summed by Spark with partial aggregation, so a hot source or bucket is a few rows per task.

Cases: NULL text reads as empty; an empty text has S = 0 and n read as 1, so it gets a defined score; labels that are
NULL, repeated with different values, or without a document teach nothing, and repeated document rows count once each;
a row with NULL doc_id is scored and not learned from; without toxic or clean training documents every word scores 0
and the score is the share of toxic labels (0.5 without labels); very long texts and words are scored whole; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stakeflow.llm.scratch import written
from stakeflow.llm.wordhash import bare, slices, split

BUCKETS = 1 << 21
PRIOR = 1000.0
FLOOR = 1.0
NEWTON_STEPS = 12
SIGNIFICANT = 0.05  # largest E-value of a reported passage
MARGIN = 0.99  # share of clean training words that score 0 or less
BROADCAST_IDS = 1_000_000  # labelled ids (12 bytes each) that are broadcast rather than joined


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each word in order, per document the index of its first word; one more at the end)."""
    words = bare(split(data, offsets))
    return (words.hashes() & np.uint64(BUCKETS - 1)).astype(np.int64), words.first


class Segments(NamedTuple):
    """Maximal segments of a slice: document, first word, last word + 1 (both counted within the document) and score."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    score: np.ndarray


def segments_of(scores: np.ndarray, first: np.ndarray) -> Segments:
    """All maximal scoring segments of each document, by the method of Ruzzo and Tompa.

    Only words that score above 0 are walked. Each held segment knows the next one on its left whose sum before it is
    lower, so that no segment is passed twice and a document costs linear time whatever its scores.
    """
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    running = pd.Series(scores, dtype="float64").groupby(doc).cumsum().to_numpy()
    before = np.zeros(len(running))
    before[1:] = running[:-1]
    before[first[:-1][first[:-1] < len(before)]] = 0.0
    at = np.flatnonzero(np.asarray(scores) > 0)
    out: list[tuple] = []  # document, start, end, sum before the start, sum at the end
    held: list[tuple] = []  # start, end, the two sums, index of the next lower one on the left
    owner = -1
    for d, i, low, high in zip(doc[at].tolist(), at.tolist(), before[at].tolist(), running[at].tolist()):
        if d != owner:
            out += [(owner, *x[:4]) for x in held]
            held, owner = [], d
        start = i
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]
            if j < 0 or held[j][3] >= high:
                held.append((start, i + 1, low, high, j))
                break
            start, low = held[j][0], held[j][2]
            del held[j:]
    out += [(owner, *x[:4]) for x in held]
    d, start, end = (np.array([x[k] for x in out], np.int64) for k in range(3))
    low, high = (np.array([x[k] for x in out], np.float64) for k in (3, 4))
    base = np.asarray(first)[d]
    return Segments(d, start - base, end - base, high - low)


def best_segments(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document, the score of its best maximal segment (0 for none)."""
    out = np.zeros(len(first) - 1)
    found = segments_of(scores, first)
    np.maximum.at(out, found.doc, found.score)
    return out


def maximal_segments(scores) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal scoring segments of one document."""
    found = segments_of(np.asarray(scores, np.float64), np.array([0, len(scores)]))
    return list(zip(found.start.tolist(), found.end.tolist(), found.score.tolist()))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words per (fold, toxic, bucket) of labelled documents."""
    for batch in batches:
        fold, toxic = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in slices(batch.column(2)):
            bucket, first = words_of(data, offsets)
            owner = np.repeat(np.arange(b - a), np.diff(first))
            key = (fold[a:b][owner] * 2 + toxic[a:b][owner]).astype(np.int64) * BUCKETS + bucket
            found, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array((found // BUCKETS).astype(np.int32)), pa.array(found % BUCKETS), pa.array(n.astype(np.int64))],
                ["kind", "bucket", "n"],
            )


def _segment_batches(shared, models: int):
    """Per document: words, and its best segment under each of the models."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(batch.num_columns - 1)):
                bucket, first = words_of(data, offsets)
                best = [best_segments(tables[m][bucket].astype(np.float64), first) for m in range(models)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(j).slice(a, b - a) for j in range(batch.num_columns - 1)),
                     pa.array(np.diff(first).astype(np.int64)), *(pa.array(x) for x in best)],
                    [*batch.schema.names[:-1], "n_words", *(f"best{m}" for m in range(models))],
                )

    return run


def _word_scores(bucket: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[np.ndarray, float]:
    """(score of every bucket, Karlin-Altschul lambda) from word counts per seen bucket in toxic and clean documents.

    A bucket's score is its log ratio less the ``MARGIN`` quantile of that ratio over clean training words, so that
    only the most toxic-leaning words of clean text score above 0; lambda solves sum_w p_clean(w) e^(lambda s_w) = 1.
    """
    out = np.zeros(BUCKETS, np.float32)
    seen = (toxic + clean) > 0
    bucket, t, c = bucket[seen], toxic[seen].astype(np.float64), clean[seen].astype(np.float64)
    nt, nc = float(t.sum()), float(c.sum())
    if nt == 0 or nc == 0:
        return out, 1.0
    alpha = PRIOR * (t + c) / (nt + nc) + FLOOR
    whole = PRIOR + FLOOR * len(bucket)
    ratio = np.log((t + alpha) / (nt + whole)) - np.log((c + alpha) / (nc + whole))
    p_clean = (c + alpha) / (nc + whole)
    order = np.argsort(ratio)
    at = np.searchsorted(np.cumsum(c[order]) / nc, MARGIN)
    s = ratio - ratio[order[min(at, len(order) - 1)]]
    out[bucket] = s.astype(np.float32)
    return out, _exponent(s, p_clean)


def _exponent(s: np.ndarray, p: np.ndarray) -> float:
    """The positive root of sum p e^(lambda s) = 1 (the mass of unseen buckets scores 0), by bisection."""
    rest = max(0.0, 1.0 - p.sum())
    gap = lambda lam: float((p * np.exp(np.clip(lam * s, -700, 700))).sum() + rest - 1.0)
    if not (s > 0).any() or gap(1e-9) >= 0:
        return 1.0
    low, high = 1e-9, 1.0
    while gap(high) < 0 and high < 1e6:
        low, high = high, high * 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if gap(mid) < 0 else (low, mid)
    return (low + high) / 2


class Model:
    """Bucket scores, lambda and K of the extreme-value law and the logistic calibration (a, b)."""

    def __init__(self, tables: np.ndarray, lam: float, k: float, a: float, b: float):
        self.tables, self.lam, self.k, self.a, self.b = tables, lam, k, a, b

    def column(self, best: Column, n_words: Column) -> Column:
        x = evidence(best, n_words, self.lam, self.k)
        return 1 / (1 + F.exp(-(F.lit(self.a) + F.lit(self.b) * x)))


def evidence(best: Column, n_words: Column, lam: float, k: float) -> Column:
    """-log E = lambda S - log(K n), compressed as sign(x) log(1 + |x|), so that a few huge segments do not steer the fit."""
    x = F.lit(lam) * best - F.log(F.lit(k) * F.greatest(n_words, F.lit(1)).cast("double"))
    return F.signum(x) * F.log1p(F.abs(x))


def _labelled(docs: DataFrame, labels: DataFrame, train: Column, key: str, text: str) -> DataFrame:
    own = labels.filter(train & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.min("toxic").alias("low"), F.max("toxic").alias("toxic")
    ).filter("low = toxic").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).filter(train)
    # Label ids are broadcast below a proven size, so that texts are not shuffled; beyond it they are joined.
    if own.count() <= BROADCAST_IDS:
        own = F.broadcast(own)
    return rows.join(own, "doc_id").select(
        "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold"), "toxic", "text"
    )


def learn(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> Model:
    """Fit bucket scores, K and the calibration on the training rows of ``labels`` (``train`` is over doc_id)."""
    spark = docs.sparkSession
    rows = written(_labelled(docs, labels, train, key, text), "toxic-train")
    # One row per seen bucket (at most BUCKETS), counts of the four kinds side by side.
    counts = rows.select("fold", "toxic", "text").mapInArrow(_count_batches, "kind int, bucket long, n long").groupBy(
        "bucket").agg(*(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4))).toArrow()
    bucket = counts.column("bucket").to_numpy()
    n = [counts.column(f"n{k}").to_numpy() for k in range(4)]
    del counts
    fitted = [_word_scores(bucket, n[1] + n[3], n[0] + n[2]), _word_scores(bucket, n[1], n[0]), _word_scores(bucket, n[3], n[2])]
    tables, lam = np.stack([t for t, _ in fitted]), [x for _, x in fitted]
    del fitted, n, bucket
    shared = spark.sparkContext.broadcast(tables)
    # Out of fold: fold 0 is scored by the model of fold 1 and the other way round.
    scored = written(rows.select("fold", "toxic", "text").mapInArrow(
        _segment_batches(shared, 3), "fold int, toxic int, n_words long, best0 double, best1 double, best2 double"
    ).select("toxic", "n_words", F.when(F.col("fold") == 0, F.lit(lam[2]) * F.col("best2")).otherwise(
        F.lit(lam[1]) * F.col("best1")).alias("best")), "toxic-scored")
    shared.destroy()
    share = scored.agg(F.avg("toxic"), F.count("*")).first()
    if share[1] == 0 or share[0] in (0, 1):
        prior = 0.5 if share[1] == 0 else min(max(float(share[0]), 1e-6), 1 - 1e-6)
        return Model(np.zeros((1, BUCKETS), np.float32), 1.0, 1.0, math.log(prior / (1 - prior)), 0.0)
    clean = scored.filter("toxic = 0").agg(
        F.count("*"), F.sum(F.greatest("n_words", F.lit(1)).cast("double") * F.exp(-F.col("best")))
    ).first()
    k = clean[0] / clean[1] if clean[0] else 1.0
    x = scored.select("toxic", evidence(F.col("best"), F.col("n_words"), 1.0, k).alias("x"))
    a, b = _logistic(x, float(share[0]))
    return Model(tables[:1].copy(), lam[0], k, a, b)


def _logistic(x: DataFrame, share: float) -> tuple[float, float]:
    """(a, b) of P(toxic) = 1 / (1 + exp(-(a + b x))) by Newton steps over all rows, with a slight ridge on b."""
    a, b = math.log(max(share, 1e-6) / max(1 - share, 1e-6)), 0.0
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("x"))))
        w = p * (1 - p)
        r = F.col("toxic") - p
        g0, g1, h00, h01, h11 = x.agg(F.sum(r), F.sum(r * F.col("x")), F.sum(w), F.sum(w * F.col("x")),
                                      F.sum(w * F.col("x") * F.col("x"))).first()
        g1, h11 = g1 - 1e-3 * b, h11 + 1e-3
        det = h00 * h11 - h01 * h01
        if not det or not math.isfinite(det):
            break
        da, db = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        a, b = a + da, b + db
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def _scored_batches(shared, lam: float, k: float):
    """Per document: words, its best segment, the number of significant maximal segments and their word spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value[0]
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                bucket, first = words_of(data, offsets)
                n_words = np.diff(first)
                found = segments_of(table[bucket].astype(np.float64), first)
                best = np.zeros(b - a)
                np.maximum.at(best, found.doc, found.score)
                fit = significant(found, n_words, lam, k)
                spans = [""] * (b - a)
                for d, start, end in sorted(zip(found.doc[fit].tolist(), found.start[fit].tolist(), found.end[fit].tolist())):
                    spans[d] += f"{',' if spans[d] else ''}{start}:{end}"
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n_words.astype(np.int64)), pa.array(best),
                     pa.array(np.bincount(found.doc[fit], minlength=b - a).astype(np.int64)), pa.array(spans, pa.string())],
                    ["doc_id", "n_words", "best", "n_passages", "passages"],
                )

    return run


def significant(found: Segments, n_words: np.ndarray, lam: float, k: float) -> np.ndarray:
    """Which segments have an E-value of at most ``SIGNIFICANT`` in a document of so many words."""
    return k * np.maximum(1, n_words[found.doc]) * np.exp(-lam * found.score) <= SIGNIFICANT


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, best, n_passages, passages, score) of every document.

    ``passages`` has the significant maximal segments as start:end by word positions (end exclusive), joined by commas.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.tables)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(
        _scored_batches(shared, model.lam, model.k), "doc_id long, n_words long, best double, n_passages long, passages string"
    )
    return found.withColumn("score", model.column(F.col("best"), F.col("n_words")))


def _passage_batches(shared, lam: float, k: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value[0]
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                bucket, first = words_of(data, offsets)
                found = segments_of(table[bucket].astype(np.float64), first)
                fit = significant(found, np.diff(first), lam, k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(found.doc[fit])),
                     *(pa.array(x[fit]) for x in (found.start, found.end, found.score))],
                    ["doc_id", "start", "end", "score"],
                )

    return run


def passages(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, score): every significant maximal segment, by word positions (end exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.tables)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_passage_batches(shared, model.lam, model.k), "doc_id long, start long, end long, score double")
