"""Language identification by unigram pieces, summed over all segmentations.

Each language has its own probabilities of the pieces of a fixed public vocabulary, learned from
labelled texts. A text is scored under each language by the forward recursion of ``lattice``; the
prediction is the language with the highest posterior, all languages being equally likely before.

Cases: NULL texts and texts without a letter are `und` with score 0; NULL lang is not learned from;
repeated rows count as often as they occur; a row with NULL doc_id is scored and not learned from; where no language can
be learned, everything is `und`; ties go to the language first in code point order; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stakeflow.llm import lattice as lat
from stakeflow.llm.lattice import Encoder, Lattice, groups

SMOOTHING = 0.1
UNKNOWN = "und"
GROUP_BYTES = 2 << 20  # of text whose distinct words are held and scored together


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text has the given remainder; a NULL key is read as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part


def _count_batches(made):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        encoder, size = Encoder(made.value), made.value["count"]
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for a, b, words in groups(batch.column(0), GROUP_BYTES):
                pieces, count = encoder.pieces(words.arrow().to_pylist())
                names, own = np.unique(langs[a:b].astype(str), return_inverse=True)
                times = np.bincount(own[words.doc] * len(words) + words.place, minlength=len(names) * len(words))
                for name, t in zip(names, times.reshape(len(names), len(words))):
                    fit = pieces >= 0
                    n = np.bincount(pieces[fit], np.repeat(t, count)[fit], size)
                    total[name] = total.get(name, 0) + n
        for name, n in total.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used)), pa.array(used), pa.array(n[used].astype(np.int64))], ["lang", "piece", "n"]
            )

    return run


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", vocabulary: str = lat.VOCABULARY) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each piece under each).

    What reaches the driver is a count per language and piece: at most the number of languages
    times the size of the vocabulary, whatever the number of documents.
    """
    spark = docs.sparkSession
    made = lat.tables(lat.read_model(vocabulary))
    shared = spark.sparkContext.broadcast(made)
    labelled = docs.filter(F.col(lang).isNotNull()).select(F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"))
    counts: pd.DataFrame = labelled.mapInArrow(_count_batches(shared), "lang string, piece long, n long").groupBy(
        "lang", "piece"
    ).agg(F.sum("n").alias("n")).toPandas()
    names = sorted(counts["lang"].unique(), key=str.encode)
    table = np.full((made["count"], len(names)), SMOOTHING)
    for i, name in enumerate(names):
        own = counts[counts["lang"] == name]
        table[own["piece"].to_numpy(), i] += own["n"].to_numpy()
    return names, np.log(table / table.sum(axis=0)) if names else table


def _score_batches(made, learned, keys: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logp = learned.value
        lattice = Lattice(made.value)
        labels = np.array([*names, UNKNOWN], object)
        for batch in batches:
            letter = np.array(batch.column(batch.num_columns - 1), bool)
            for a, b, words in groups(batch.column(at), GROUP_BYTES):
                best = np.full(b - a, len(names))
                score = np.zeros(b - a)
                if names:
                    word = lattice.marginals(words.data, words.start, words.end, logp)
                    total = np.stack([
                        np.bincount(words.doc, word[words.place, g], b - a) for g in range(len(names))
                    ], axis=1)
                    share = np.exp(total - total.max(axis=1, keepdims=True))
                    share /= share.sum(axis=1, keepdims=True)
                    best = np.where(letter[a:b], share.argmax(axis=1), best)
                    score = np.where(letter[a:b], share.max(axis=1), score)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(keys)), pa.array(list(labels[best]), pa.string()), pa.array(score)],
                    [*batch.schema.names[:keys], "lang_pred", "score"],
                )

    return run


def predict(
    docs: DataFrame, names: list[str], logp: np.ndarray, text: str = "text", keep: list[str] | None = None,
    vocabulary: str = lat.VOCABULARY,
) -> DataFrame:
    """The columns ``keep`` of each document (all by default) with lang_pred and score. No shuffle."""
    spark = docs.sparkSession
    context = spark.sparkContext
    made, learned = context.broadcast(lat.tables(lat.read_model(vocabulary))), context.broadcast((names, logp))
    kept = docs.select(*keep) if keep is not None else docs
    kept = kept.drop("lang_pred", "score")
    content = docs[text].cast("string")
    # The text travels once: as a kept column, or else beside them.
    at = kept.columns.index(text) if text in kept.columns and dict(kept.dtypes)[text] == "string" else len(kept.columns)
    rows = docs.select(
        *[docs[c] for c in kept.columns], *([content.alias("__text")] if at == len(kept.columns) else []),
        F.coalesce(content.rlike(r"\p{L}"), F.lit(False)).alias("__letter"),
    )
    fields = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes)
    return rows.mapInArrow(
        _score_batches(made, learned, len(kept.columns), at), f"{fields}, lang_pred string, score double"
    )


def identify(docs: DataFrame, parts: int = 4, part: int = 2, vocabulary: str = lat.VOCABULARY, keep: list[str] | None = None) -> DataFrame:
    """Learn from the documents outside the held-out part, predict all of them."""
    train = docs.filter(~held_out(F.col("doc_id"), parts, part) & F.col("doc_id").isNotNull())
    names, logp = learn(train, vocabulary=vocabulary)
    return predict(docs, names, logp, keep=keep, vocabulary=vocabulary)


def digest(found: DataFrame, parts: int = 4, part: int = 2) -> DataFrame:
    return found.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "lang_pred", "score")
