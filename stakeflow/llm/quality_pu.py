"""A quality classifier from positive and unlabelled documents.

Trusted positives are labelled documents of good quality; any other document is unlabelled, whatever its label.
With the class prior p, the risk of calling unlabelled documents bad is corrected for the good ones among them:

    p E_pos[loss(+)] + max(0, E_unl[loss(-)] - p E_pos[loss(-)])

The second part cannot be negative in truth; where it is on the sample, its gradient is taken back (non-negative
unbiased risk). The prior is the share of good documents among labelled training rows.

The model adds one weight per bin of each text feature. It is fitted on the driver on at most ``SAMPLE`` positives and as
many unlabelled documents, chosen by a seeded hash, and then scores every document.

Cases: NULL text reads as empty and is scored; labels that are NULL, repeated with different values, or without a document teach
nothing; without any positive or unlabelled document every score is the prior, or 0.5 without a
prior; NULL doc_id is scored and not learned from; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stakeflow.llm.language_id import held_out
from stakeflow.llm.wordhash import mix, slices, split

SAMPLE = 8000  # documents of each kind that are fitted on
BINS = 24
STEPS = 1500
# The classes of bytes whose shares are features.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".!?", b",;:", b"\"'()-", b"*#$%&@^~_=+<>|\\/{}[]`", b"\n", bytes(range(128, 256)))


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per document; shares are of bytes, words or lines."""
    size = np.diff(offsets)
    n = len(size)
    columns = [np.log1p(size)]
    for members in CLASSES:
        held = np.zeros(256, np.int64)
        held[list(members)] = 1
        total = np.concatenate([[0], np.cumsum(held[data])])
        columns.append((total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(1, size))
    words = split(data, offsets)
    h, count = words.hashes(), np.diff(words.first)
    some = np.maximum(1, count)
    length = words.end - words.start
    per_doc = lambda x: np.bincount(words.doc, x, n) / some
    columns += [np.log1p(count), per_doc(length), per_doc(length <= 2), per_doc(length >= 12)]

    def repeated(keys: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
        """Share of distinct keys, share of the commonest one."""
        order = np.lexsort((keys, doc))
        k, d = keys[order], doc[order]
        lead = np.flatnonzero(np.concatenate([np.ones(min(1, len(k)), bool), (k[1:] != k[:-1]) | (d[1:] != d[:-1])]))
        run, own = np.diff(np.append(lead, len(k))), d[lead]
        total = np.maximum(1, np.bincount(doc, minlength=n))
        most = np.zeros(n)
        np.maximum.at(most, own, run)
        return [np.bincount(own, minlength=n) / total, most / total]

    columns += repeated(h, words.doc)
    after = np.flatnonzero(words.doc[1:] == words.doc[:-1])
    columns += repeated(mix(h[after] * np.uint64(3) + h[after + 1]), words.doc[after])
    last = data[words.end - 1] if len(words.end) else np.zeros(0, np.uint8)
    columns += [per_doc(np.isin(last, list(b".!?"))), per_doc(np.isin(last, list(CLASSES[5])))]
    # Lines by the words they hold.
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    if len(h):
        line = breaks[words.start]
        lead = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (words.doc[1:] != words.doc[:-1])]))
        columns += repeated(np.add.reduceat(h, lead), words.doc[lead])
    else:
        columns += [np.zeros(n), np.zeros(n)]
    return np.column_stack(columns)


class Model(NamedTuple):
    edges: np.ndarray  # features x (BINS - 1)
    weights: np.ndarray  # features x BINS
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for f in range(len(self.edges)):
            total += self.weights[f, np.searchsorted(self.edges[f], x[:, f], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, l2: float = 1e-4) -> Model:
    """Minimise the non-negative unbiased risk with logistic loss, by Adam over all rows."""
    both = np.concatenate([positive, unlabelled])
    edges = np.stack([np.quantile(both[:, f], np.arange(1, BINS) / BINS) for f in range(both.shape[1])])
    width = len(edges) * BINS
    place = np.stack([np.searchsorted(edges[f], both[:, f], "right") + f * BINS for f in range(len(edges))], axis=1)
    p = len(positive)
    weights = np.zeros(width + 1)
    first, second = np.zeros(width + 1), np.zeros(width + 1)

    def gradient(slope: np.ndarray) -> np.ndarray:
        g = np.bincount(place.ravel(), np.repeat(slope, place.shape[1]), width)
        return np.append(g, slope.sum())

    for step in range(1, steps + 1):
        margin = weights[place].sum(axis=1) + weights[-1]
        s = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        as_bad = np.logaddexp(0, margin)
        excess = as_bad[p:].mean() - prior * as_bad[:p].mean()
        slope = np.zeros(len(both))
        bad = np.zeros(len(both))
        bad[p:], bad[:p] = s[p:] / max(1, len(unlabelled)), -prior * s[:p] / p
        if excess >= 0:
            slope[:p] = prior * (s[:p] - 1) / p
            slope += bad
        else:
            slope -= bad
        g = gradient(slope)
        g[:-1] += l2 * weights[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        weights -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(edges, weights[:-1].reshape(len(edges), BINS), float(weights[-1]))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in slices(batch.column(1)):
            x = text_features(data, offsets)
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["kind", "x"])


def _score_batches(shared, constant: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value and Model(*shared.value)
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                s = model.scores(text_features(data, offsets)) if model else np.full(b - a, constant)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(s)], ["doc_id", "score"])

    return run


def learn(docs: DataFrame, labels: DataFrame, train: Column, text: str = "text", sample: int = SAMPLE, seed: int = 11) -> tuple[Model | None, float]:
    """(model, class prior) from training rows.

    The two samples are ids, at most ``2 * sample`` of them, so they are broadcast; features are made where the texts are.
    """
    own = labels.filter(train & F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("quality")
    ).filter("low = quality").select("doc_id", "quality")
    prior = own.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").agg(F.avg(F.col("quality").cast("double"))).first()[0]
    order = F.xxhash64(F.col("doc_id"), F.lit(seed))
    ids = docs.filter(train & F.col("doc_id").isNotNull()).select("doc_id")
    positive = ids.join(own.filter("quality = 1"), "doc_id", "left_semi").distinct().orderBy(order).limit(sample)
    unlabelled = ids.distinct().orderBy(order, "doc_id").limit(sample)
    chosen = positive.withColumn("kind", F.lit(1)).unionByName(unlabelled.withColumn("kind", F.lit(0)))
    texts = docs.select("doc_id", F.col(text).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("kind", "text")
    found = rows.mapInArrow(_feature_batches, "kind int, x array<double>").toPandas()
    pos, unl = (np.stack(found.loc[found["kind"] == k, "x"]) if (found["kind"] == k).any() else None for k in (1, 0))
    if pos is None or unl is None:
        return None, 0.5 if prior is None else float(prior)
    # A fixed order, so that reruns add up alike.
    pos, unl = pos[np.lexsort(pos.T)], unl[np.lexsort(unl.T)]
    return fit(pos, unl, float(prior)), float(prior)


def score(docs: DataFrame, labels: DataFrame, train: Column, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score) of every document: the probability that its quality is good."""
    model, prior = learn(docs, labels, train, text, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model and tuple(model))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_score_batches(shared, prior), "doc_id long, score double")


def digest(found: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    return found.select(
        "doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
