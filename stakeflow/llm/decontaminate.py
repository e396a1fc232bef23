"""Find benchmark items in documents through a BM25 index of the items.

The index is over the test items; every passage of every document is a query. Weights are divided by
the score an item gives itself, so a score is the share of the item's weight that a passage covers,
and one threshold fits all items. Items lie in blocks. A passage first adds the block maxima of its
terms, for all blocks at once; a block whose sum stays below the threshold cannot hold an item to
retrieve. In the other blocks WAND moves from pivot to pivot. Every item above the threshold is then
verified: 0.8 of the five-word shingles of the whole item, those across question and answer included, must be
found in the passage, or 0.8 of those of its question and of its answer each, wherever these stand in it. Words
are compared without the punctuation before and after them.

A passage is two adjoining cells of at least the words of the longest item, and cells advance one by
one, so an item is never cut.

Cases: NULL, empty and blank texts hold nothing; items without words are never found; repeated
documents are each reported, a repeated item_id once per document; a NULL doc_id or item_id is reported as
NULL; an item with one sentence has no answer part; an empty table on either side gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stakeflow.llm.scratch import written
from stakeflow.llm.wordhash import bare, runs, shingles, slices, split

K1, B = 1.2, 0.75
BLOCK = 4  # items
SHARD = 2048  # items of one index; a larger benchmark takes several passes over the documents
LEAST_CELL = 32  # words
SENTENCE = re.compile(r"(?<=[.!?])\s+")
FOUND = "doc_id long, item_id long, score double, item_overlap double, question_overlap double, answer_overlap double"
PARTS = ("item", "question", "answer")


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer; a single sentence is all question."""
    parts = SENTENCE.split(text.strip())
    return " ".join(parts[:-1] or parts), parts[-1] if len(parts) > 1 else ""


def hashed(texts: list[str], k: int | None = None) -> list[np.ndarray]:
    """Word hashes of each text, or its distinct k-word shingles."""
    out = []
    for _, _, data, offsets in slices(pa.array(texts, pa.string())):
        words = bare(split(data, offsets))
        h, first = (words.hashes(), words.first) if k is None else shingles(words, k)
        out += [np.unique(h[a:b]) if k else h[a:b] for a, b in zip(first, first[1:])]
    return out


def build_index(ids: list, texts: list[str], k: int = 5, whole: tuple[int, int, dict[int, int]] | None = None) -> dict:
    """An index of some items, as plain arrays and dicts that can be broadcast.

    ``whole`` has the number of items and words and the items with each term, over all shards.
    """
    words = hashed(texts)
    some = [i for i, w in enumerate(words) if len(w)]
    words = [words[i] for i in some]
    parts = [(texts[i], *question_and_answer(texts[i])) for i in some]
    terms = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
    n, mean = len(words), np.mean([len(w) for w in words]) if words else 1.0
    counted = [np.unique(w, return_counts=True) for w in words]
    df = np.bincount(np.concatenate([np.searchsorted(terms, t) for t, _ in counted]), minlength=len(terms)) if words else np.zeros(0)
    total = n
    if whole:
        total, mean, df = whole[0], whole[1] / whole[0], np.array([whole[2][t] for t in terms.view(np.int64).tolist()])
    idf = np.log1p((total - df + 0.5) / (df + 0.5))
    blocks = -(-n // BLOCK)
    ceiling = np.zeros((len(terms) + 1, blocks), np.float32)
    postings: dict[tuple[int, int], tuple[list, list]] = {}
    for item, (t, tf) in enumerate(counted):
        at = np.searchsorted(terms, t)
        weight = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words[item]) / mean))
        weight /= weight.sum()
        for a, w in zip(at.tolist(), weight.tolist()):
            items, weights = postings.setdefault((a, item // BLOCK), ([], []))
            items.append(item)
            weights.append(w)
        np.maximum.at(ceiling[:, item // BLOCK], at, weight.astype(np.float32) * 1.000001)
    return {
        "terms": terms, "ceiling": ceiling, "postings": postings, "ids": [ids[i] for i in some],
        **{x: hashed([p[i] for p in parts], k) for i, x in enumerate(PARTS)},
        "lengths": {x: [len(h) for h in hashed([p[i] for p in parts])] for i, x in enumerate(PARTS)},
        "cell": max([LEAST_CELL, *map(len, words)]), "k": k,
    }


def wand(index: dict, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
    """Items of a block whose score for a set of terms reaches the threshold."""
    ceiling = index["ceiling"]
    lists = [[0, *index["postings"][t, block], float(ceiling[t, block])] for t in terms if (t, block) in index["postings"]]
    found = []
    while lists:
        lists.sort(key=lambda x: x[1][x[0]])
        total, pivot = 0.0, None
        for at, items, _, most in lists:
            total += most
            if total >= threshold:
                pivot = items[at]
                break
        if pivot is None:
            break
        if lists[0][1][lists[0][0]] == pivot:
            score = 0.0
            for x in lists:
                if x[1][x[0]] != pivot:
                    break
                score += x[2][x[0]]
                x[0] += 1
            if score >= threshold:
                found.append((pivot, score))
        else:
            for x in lists:
                if x[1][x[0]] >= pivot:
                    break
                x[0] = bisect_left(x[1], pivot, x[0])
        lists = [x for x in lists if x[0] < len(x[1])]
    return found


def covered(part: np.ndarray, length: int, passage: np.ndarray, k: int) -> float:
    """Share of a part's k-word shingles found among the words of a passage; a shorter part counts as one."""
    if not length:
        return 1.0
    return float(np.isin(part, runs(passage, min(k, length))).mean())


class Finder:
    """Look-up of words among the index's terms, then block maxima, WAND and verification."""

    def __init__(self, index: dict, threshold: float, overlap: float):
        self.index, self.threshold, self.overlap = index, threshold, overlap
        top = (index["terms"] >> np.uint64(44)).astype(np.int64)
        self.start = np.searchsorted(top, np.arange(1 << 20)).astype(np.int32)
        self.run = int(np.bincount(top).max())
        self.terms = np.append(index["terms"], np.zeros(self.run, np.uint64))

    def term_of(self, h: np.ndarray) -> np.ndarray:
        """Number of the term with each hash, or -1."""
        near = self.start[(h >> np.uint64(44)).astype(np.int64)]
        term = np.full(len(h), -1)
        for step in range(self.run):
            hit = self.terms[near + step] == h
            term[hit] = near[hit] + step
        return term

    def search(self, column: pa.Array) -> Iterator[tuple[int, int, float, float, float, float]]:
        """(row, item, score, overlaps of the whole item, its question and its answer) of each row and item, from the first passage that has it."""
        index, terms, ceiling, cell = self.index, len(self.index["terms"]), self.index["ceiling"], self.index["cell"]
        for a, b, data, offsets in slices(column):
            words = bare(split(data, offsets))
            h = words.hashes()
            term = self.term_of(h)
            known = np.flatnonzero(term >= 0)
            if not len(known):
                continue
            cells = -(-np.diff(words.first) // cell)
            base = np.concatenate([[0], np.cumsum(cells)])
            doc = words.doc[known]
            place = base[doc] + (known - words.first[doc]) // cell
            pairs = np.unique(place * np.int64(terms) + term[known])
            own, what = pairs // terms, pairs % terms
            lead = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            bound = np.zeros((base[-1] + 1, ceiling.shape[1]), np.float32)
            bound[own[lead]] = np.add.reduceat(ceiling[what], lead, axis=0)
            owner = np.repeat(np.arange(b - a), cells)
            together = bound[:-1].copy()
            same = np.flatnonzero(owner[1:] == owner[:-1])
            together[same] += bound[1:-1][same]
            edges = np.searchsorted(own, np.arange(base[-1] + 2))
            seen = set()
            for p, block in zip(*(x.tolist() for x in np.nonzero(together >= self.threshold))):
                d = int(owner[p])
                last_cell = p + 2 if p + 1 < len(owner) and owner[p + 1] == d else p + 1
                held = sorted(set(what[edges[p]:edges[last_cell]].tolist()))
                first = int(words.first[d] + (p - base[d]) * cell)
                last = min(int(words.first[d + 1]), first + 2 * cell)
                for item, score in wand(index, held, block, self.threshold):
                    if (d, item) in seen:
                        continue
                    whole, asked, answered = (
                        covered(index[x][item], index["lengths"][x][item], h[first:last], index["k"]) for x in PARTS
                    )
                    if max(whole, min(asked, answered)) >= self.overlap:
                        seen.add((d, item))
                        yield a + d, item, score, whole, asked, answered


def _find_batches(shared, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value, threshold, overlap)
        for batch in batches:
            found = list(finder.search(batch.column(1)))
            if found:
                rows, items, *figures = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array([shared.value["ids"][i] for i in items], pa.int64()),
                     *(pa.array(x, pa.float64()) for x in figures)],
                    ["doc_id", "item_id", "score", *(f"{x}_overlap" for x in PARTS)],
                )

    return run


def _clean_batches(shared, threshold: float, overlap: float, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value, threshold, overlap)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[row for row, *_ in finder.search(batch.column(at))]] = False
            yield batch.filter(pa.array(keep))

    return run


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, term, words) of each item's terms; the first term of an item carries its number of words."""
    for batch in batches:
        own = hashed(batch.column(1).to_pylist())
        terms = [np.unique(w) for w in own]
        shard = np.repeat(np.array(batch.column(0)), [len(t) for t in terms])
        words = [np.where(np.arange(len(t)) == 0, len(w), 0) for t, w in zip(terms, own)]
        if len(shard):
            yield pa.RecordBatch.from_arrays([
                pa.array(shard), pa.array(np.concatenate(terms).view(np.int64)), pa.array(np.concatenate(words).astype(np.int64)),
            ], ["shard", "term", "words"])


def indexes(items: DataFrame, shard: int = SHARD) -> Iterator[dict]:
    """An index of each shard of the items; one for a benchmark of at most ``shard`` items."""
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shards = max(1, -(-tests.count() // shard))
    tests = tests.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    if shards > 1:
        # Weights are those of one index over all items: terms of a shard come with their counts in the whole.
        terms = written(tests.select("shard", "text").mapInArrow(_term_batches, "shard long, term long, words long"), "terms")
        count, words = terms.agg(F.count(F.when(F.col("words") > 0, 1)), F.sum("words")).first()
        df = written(terms.groupBy("term").agg(F.count("*").alias("n")), "term-counts")
    for i in range(shards):
        own = tests.filter(F.col("shard") == i).orderBy("item_id", "text").collect()
        whole = None
        if shards > 1:
            held = terms.filter(F.col("shard") == i).select("term").distinct().join(df, "term").collect()
            whole = (count, words, {r["term"]: r["n"] for r in held})
        index = build_index([r["item_id"] for r in own], [r["text"] for r in own], whole=whole)
        if index["ids"]:
            yield index


def without_items(
    docs: DataFrame, items: DataFrame, text: str = "text", threshold: float = 0.5, overlap: float = 0.8, shard: int = SHARD,
) -> DataFrame:
    """``docs`` without the rows in which an item is found, in place: nothing is shuffled or joined."""
    out = docs
    for index in indexes(items, shard):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        out = out.mapInArrow(_clean_batches(shared, threshold, overlap, docs.columns.index(text)), docs.schema)
    return out


def find_items(
    docs: DataFrame, items: DataFrame, text: str = "text", threshold: float = 0.5, overlap: float = 0.8, shard: int = SHARD,
) -> DataFrame:
    """Rows of FOUND: one per document and item found in it, with the best passage's figures.

    Up to ``shard`` items are indexed at a time and broadcast, a few MB; more items are taken in
    further shards, each in its own pass over the documents.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = [
        rows.mapInArrow(_find_batches(spark.sparkContext.broadcast(index), threshold, overlap), FOUND)
        for index in indexes(items, shard)
    ]
    if not parts:
        return spark.createDataFrame([], FOUND)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"), *[F.max(f"{x}_overlap").alias(f"{x}_overlap") for x in PARTS],
    )
