"""How five document filters interact, in every order they can be applied.

Each text goes once through a table-driven byte transducer: a 256-entry table gives every byte its class
(word break, capital A-Z, symbol, UTF-8 continuation, other), and one pass over the classes counts words, capitals,
code points and symbols. Word spans go into a hash table (64-bit hashes of the bytes, sorted per document) whose
equal entries are verified byte by byte, so two different words never count as one. The work runs in numpy over
slices of a few MB of a partition's texts.

Failure conditions (words: maximal runs outside 0x20 and 0x09-0x0D, case-sensitive):

- A: fewer than ``MIN_WORDS`` words
- B: 100 * distinct words < 50 * words
- C: 100 * capitals A-Z > 2 * code points
- D: any of ``SYMBOLS``
- E: the same text as a row with a smaller doc_id, anywhere in the table, whatever the other filters say

Exact copies are found by SHA-256 of the text; a text held by more than ``HOT_COPIES`` rows (and by a share of the
table that keeps such texts under ``MAX_HOT_TEXTS``) has its smallest id broadcast, so a large group of copies is
not shuffled into one task. A document's failures are a mask of five bits. Documents are counted per (part, mask) with partial sums before any
shuffle, so a part with a third of the rows is only a few rows per task. From the 32 counts of a part, every order of
the five filters (120) and step follows by array functions, with no join of documents to orders.

Cases: NULL text reads as empty (it fails A, and E when a smaller doc_id is empty or NULL too); a NULL part is the
empty string; a NULL doc_id is never smaller than another, so it neither fails E nor makes others fail it; repeated rows
count once each (the copy with the same doc_id does not fail E, having no smaller id); labels count a document as good
(toxic) if any of its label rows has quality (toxic) 1, whatever NULLs or other rows say; very long texts are counted
whole; an empty table gives no rows; other columns, of any name, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stakeflow.llm.scratch import written
from stakeflow.llm.wordhash import mix, powers, slices

# Fixed values of the audit.
LETTERS = "ABCDE"
MIN_WORDS = 200
SYMBOLS = b"#$%&*|"
BREAKS = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])

# Byte classes of the transducer.
OTHER, BREAK, CAPITAL, SYMBOL, FOLLOW = range(5)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[0x80:0xC0] = FOLLOW
CLASS[ord("A"):ord("Z") + 1] = CAPITAL
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[list(BREAKS)] = BREAK

_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 2**64)
_SALT = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))

HOT_COPIES = 1000  # rows of one text above which its smallest id is broadcast
MAX_HOT_TEXTS = 100_000  # texts broadcast at most: the threshold rises with the table

COUNTS = "n_words long, n_distinct long, n_capitals long, n_code_points long, n_symbols long"


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, independent of where the span lies."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up = powers(_BASE, len(data) + 1)
    down = powers(_INVERSE, len(data) + 1)
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(_SALT[data] * up[:-1], dtype=np.uint64)])
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of equal ``size`` starting at ``a`` and ``b`` hold the same bytes."""
    if not len(a):
        return np.zeros(0, bool)
    total = int(size.sum())
    if total == 0:
        return np.ones(len(a), bool)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    inner = np.arange(total) - np.repeat(first, size)
    equal = data[np.repeat(a, size) + inner] == data[np.repeat(b, size) + inner]
    out = np.ones(len(a), bool)
    some = size > 0
    out[some] = np.logical_and.reduceat(equal, first[some])
    return out


def transduce(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts per document of the bytes between consecutive ``offsets``: words, distinct words, capitals, code points, symbols."""
    n = len(offsets) - 1
    kind = CLASS[data]
    doc = np.repeat(np.arange(n), np.diff(offsets))
    per_doc = lambda mask: np.bincount(doc[mask], minlength=n)
    inside = kind != BREAK
    # A word starts where a non-break byte follows a break or the start of its document.
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[:-1][(offsets[:-1] < len(data)) & (np.diff(offsets) > 0)]
    begins[cut] = inside[cut]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    owner = doc[start]
    h = _word_hashes(data, start, end)
    order = np.lexsort((h, owner))
    owner, h, start, end = owner[order], h[order], start[order], end[order]
    repeat = np.flatnonzero((owner[1:] == owner[:-1]) & (h[1:] == h[:-1])) + 1
    # Verify every entry found equal to its neighbour; a collision makes its document count by bytes.
    size = end[repeat] - start[repeat]
    verified = (size == end[repeat - 1] - start[repeat - 1])
    verified[verified] = _same_bytes(data, start[repeat][verified], start[repeat - 1][verified], size[verified])
    distinct = np.bincount(owner, minlength=n) - np.bincount(owner[repeat[verified]], minlength=n)
    for d in np.unique(owner[repeat[~verified]]):
        mine = owner == d
        distinct[d] = len({data[s:e].tobytes() for s, e in zip(start[mine], end[mine])})
    return np.column_stack([
        np.bincount(owner, minlength=n), distinct, per_doc(kind == CAPITAL), per_doc(kind != FOLLOW), per_doc(kind == SYMBOL),
    ]).astype(np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns before the last, then the counts of the last (the text)."""
    names = [c.split()[0] for c in COUNTS.split(", ")]
    for batch in batches:
        kept = batch.num_columns - 1
        for a, b, data, offsets in slices(batch.column(kept)):
            counted = transduce(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(j).slice(a, b - a) for j in range(kept)), *(pa.array(counted[:, j]) for j in range(len(names)))],
                [*batch.schema.names[:kept], *names],
            )


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` with n_words, n_distinct, n_capitals, n_code_points and n_symbols of ``text``."""
    others = [c for c in docs.columns if c != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text), COUNTS])
    return docs.select(*others, F.col(text).cast("string").alias(text)).mapInArrow(_count_batches, schema)


def failures(docs: DataFrame, text: str = "text", key: str = "doc_id", part: str = "source") -> DataFrame:
    """(doc_id, part, mask): bit i of mask set where the document fails filter ``LETTERS[i]``."""
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("same", F.sha2("text", 256))
    first = written(rows.groupBy("same").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "audit-copies")
    counted = counts(rows.select("doc_id", "part", "same", "text"))
    # Texts held by many rows would put all their rows into one task of a shuffled join. They are at most
    # (rows / HOT_COPIES) texts, so their smallest ids are broadcast; only the other rows are shuffled.
    total = first.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") > max(HOT_COPIES, total // MAX_HOT_TEXTS)
    many = first.filter(hot).select("same", "least")
    found = counted.join(F.broadcast(many), "same", "left").withColumnRenamed("least", "hot_least").join(
        first.filter(~hot).select("same", "least"), "same", "left"
    ).withColumn("least", F.coalesce("hot_least", "least"))
    fails = [
        F.col("n_words") < MIN_WORDS,
        100 * F.col("n_distinct") < 50 * F.col("n_words"),
        100 * F.col("n_capitals") > 2 * F.col("n_code_points"),
        F.col("n_symbols") > 0,
        F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)),
    ]
    mask = sum(F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails))
    return found.select("doc_id", "part", mask.cast("int").alias("mask"))


def _orders() -> list[tuple[str, int, int, int]]:
    """(filter_order, step, bit of its filter, bits of the filters before it) for all orders of ``LETTERS``."""
    out = []
    for order in permutations(LETTERS):
        earlier = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << LETTERS.index(letter)
            out.append(("".join(order), step, bit, earlier))
            earlier |= bit
    return out


def _summed(array: str, condition: str) -> F.Column:
    return F.expr(f"aggregate(sequence(0, 31), 0L, (total, m) -> total + IF({condition}, {array}[m], 0L))")


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    flags = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q"), F.col("toxic").alias("t")
    ).groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("q") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("t") == 1).cast("int"), F.lit(0))).alias("toxic"),
    )
    masked = failures(docs, text, key, part).join(flags, "doc_id", "left").fillna(0, ["good", "toxic"])
    by_mask = masked.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"),
    )
    hist = by_mask.groupBy("part").agg(*(
        F.array(*(F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)).cast("long") for m in range(32))).alias(f"{c}s")
        for c in ("n", "good", "toxic")
    ))
    plan = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(e).alias("earlier"))
                     for o, s, b, e in _orders()))
    steps = hist.select("*", F.inline(plan))
    removed = "(m & bit) <> 0 AND (m & earlier) = 0"
    out = steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "bit",
        _summed("ns", "(m & (earlier | bit)) = 0").alias("kept"),
        _summed("ns", removed).alias("removed"),
        _summed("ns", "(m & bit) <> 0 AND (m & earlier) <> 0").alias("redundant"),
        _summed("ns", "m = bit").alias("unique_fails"),
        _summed("goods", removed).alias("good_lost"),
        _summed("toxics", removed).alias("toxic_lost"),
    )
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")
