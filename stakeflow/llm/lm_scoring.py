"""Language-model scores of documents: a lattice of subwords, and smoothed word counts beside it.

The model has one probability per piece of a public vocabulary and one for the end of a text. The
vocabulary's own scores segment the training words, the counts of pieces found so make the unigram scores, and
the probability of a text is the sum over all segmentations of its words (``lattice``).

Every distinct word is counted and scored once, in a table. Words that make up a fixed share of
all training tokens, of which there can only be so many, are broadcast; occurrences of the others are summed
per document and joined with the table. No frequent word is ever a join key.

Cases: NULL text reads as empty; an empty text scores the end alone; where nothing can be learned
N is 0 and the scores come from smoothing alone; repeated rows are scored each and count each; a NULL
doc_id is scored as any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stakeflow.llm import lattice as lat
from stakeflow.llm.lattice import Encoder, Lattice, groups
from stakeflow.llm.scratch import small_batches, written

SHARE = 1 << 17  # a word with at least 1/SHARE of the tokens is broadcast, so at most SHARE words are
GROUP_BYTES = 4 << 20  # of text held at a time
PIECE_SMOOTHING = 0.1
ADD = 0.1
SCORES = "row long, doc_id long, word string, times long, tokens long, known long, base double, score double"


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, occurrences in training texts) of each distinct word of a group of documents."""
    for batch in batches:
        train = np.array(batch.column(1), bool)
        for a, b, words in groups(batch.column(0), GROUP_BYTES):
            n = np.bincount(words.place, train[a:b][words.doc], len(words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([words.arrow(), pa.array(n)], ["word", "n"])


def _piece_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = Encoder(shared.value), np.zeros(shared.value["count"], np.int64)
        for batch in batches:
            pieces, count = encoder.pieces(batch.column(0).to_pylist())
            times = np.repeat(np.array(batch.column(1)), count)
            fit = pieces >= 0
            total += np.bincount(pieces[fit], times[fit], len(total)).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "n"])

    return run


def _marginal_batches(shared, learned):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, logp = Lattice(shared.value), learned.value[:, None]
        for batch in batches:
            column = batch.column(0).cast(pa.large_string())
            _, where, what = column.buffers()
            offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
            score = lattice.marginals(np.frombuffer(what, np.uint8), offsets[:-1], offsets[1:], logp)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score[:, 0] / math.log(10))], ["word", "n", "logp"]
            )

    return run


def learn_words(docs: DataFrame, train: Column, text: str = "text", vocabulary: str = lat.VOCABULARY) -> tuple[DataFrame, float]:
    """((word, n, logp) of every distinct word, log10 probability of the end).

    ``n`` counts training occurrences, ``logp`` is the log10 marginal probability. The only thing that
    passes through the driver is one count per piece of the vocabulary.
    """
    context = docs.sparkSession.sparkContext
    made = lat.tables(lat.read_model(vocabulary))
    shared = context.broadcast(made)
    rows = docs.select(F.col(text).cast("string").alias("text"), train.alias("train"))
    with small_batches(docs.sparkSession):
        words = written(
            rows.mapInArrow(_word_batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words"
        )
    pieces = words.filter("n > 0").mapInArrow(_piece_batches(shared), "piece long, n long").groupBy("piece").agg(
        F.sum("n").alias("n")
    ).toPandas()
    texts = rows.filter("train").count()
    weight = np.full(made["count"] + 1, PIECE_SMOOTHING)  # the last is the end of a text
    weight[pieces["piece"].to_numpy()] += pieces["n"].to_numpy()
    weight[-1] += texts
    logp = np.log(weight / weight.sum())
    learned = context.broadcast(logp[:-1])
    scored = words.mapInArrow(_marginal_batches(shared, learned), "word string, n long, logp double")
    return written(scored, "word-scores"), float(logp[-1] / math.log(10))


def _document_batches(head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, n, base, logp = head.value
        for batch in batches:
            row, ids = np.array(batch.column(0)), batch.column(1)
            for a, b, words in groups(batch.column(2), GROUP_BYTES):
                size = b - a
                known = np.isin(words.hash, names)
                at = np.searchsorted(names, words.hash[known])
                value = np.zeros((len(words), 3))
                value[known] = np.column_stack([n[at] > 0, base[at], logp[at]])
                sums = [np.bincount(words.doc, value[words.place, i], size).astype(np.float64) for i in range(3)]
                # One row with the sums over broadcast words; its key is no word, so it meets nothing.
                none = pa.nulls(size, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(row[a:b]), ids.slice(a, size), pa.array([f" {r}" for r in row[a:b]]), none,
                    pa.array(words.tokens), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]),
                ], ["row", "doc_id", "word", "times", "tokens", "known", "base", "score"])
                rare = np.flatnonzero(~known[words.place])
                pairs, times = np.unique(words.doc[rare] * np.int64(len(words)) + words.place[rare], return_counts=True)
                doc, word = pairs // max(1, len(words)), pairs % max(1, len(words))
                for low in range(0, len(pairs), 1 << 17):
                    part = slice(low, low + (1 << 17))
                    size = len(pairs[part])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(row[a:b][doc[part]]), pa.nulls(size, pa.int64()), words.arrow(word[part]), pa.array(times[part]),
                        pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64()), pa.nulls(size, pa.float64()), pa.nulls(size, pa.float64()),
                    ], ["row", "doc_id", "word", "times", "tokens", "known", "base", "score"])

    return run


def _word_hashes(words: list[str]) -> np.ndarray:
    from stakeflow.llm.wordhash import slices, split

    parts = [split(data, offsets).hashes() for _, _, data, offsets in slices(pa.array(words, pa.string()))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def score(docs: DataFrame, train: Column, text: str = "text", vocabulary: str = lat.VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every document.

    The end of a text counts as a token of its own. ``base_score`` sums log10((c + 0.1) / (N + 0.1 (V + 1)))
    over tokens.
    """
    context = docs.sparkSession.sparkContext
    words, end_score = learn_words(docs, train, text, vocabulary)
    total = words.filter("n > 0").agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    texts = docs.filter(train).count()
    n, v = (total["n"] or 0) + texts, total["v"] + (1 if texts else 0)
    floor = n + ADD * (v + 1)
    frequent = words.filter(F.col("n") >= max(1, math.ceil(n / SHARE))).toPandas()
    names = _word_hashes(list(frequent["word"]))
    order = np.argsort(names)
    count = frequent["n"].to_numpy(np.float64)[order]
    head = context.broadcast((
        names[order], count, np.log10((count + ADD) / floor), frequent["logp"].to_numpy(np.float64)[order]
    ))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    with small_batches(docs.sparkSession):
        found = written(rows.mapInArrow(_document_batches(head), SCORES), "occurrences")
    times = F.col("times")
    each = found.join(words, "word", "left").select(
        "row", "doc_id", "tokens",
        F.coalesce("known", F.when(F.col("n") > 0, times), F.lit(0)).alias("known"),
        F.coalesce("base", times * F.log10((F.col("n") + ADD) / floor)).alias("base"),
        F.coalesce("score", times * F.col("logp")).alias("score"),
    )
    end_base = math.log10((texts + ADD) / floor)
    return each.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), (F.max("tokens") + 1).alias("n_tokens"),
        (F.sum("known") + (1 if texts else 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.sum("base") + end_base).alias("base_score"), (F.sum("score") + end_score).alias("score"),
    ).drop("row")
