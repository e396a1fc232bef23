"""Token counts as rollups kept by signed deltas.

A document counted under a tokenizer version is a fact. Inserting it adds its tokens, deleting it takes them away, and
a revised count is both. Deltas are summed by source, language and tokenizer version and stored
one folder per batch; totals are the sum over all batches. Committing a batch again replaces its folder, so a retried
or repeated commit changes nothing.

Cases: NULL text has 0 tokens; NULL source and lang are groups of their own; repeated rows are counted as often as they
occur by ``insertions``, while ``revisions`` compares totals per doc_id, in which repeated rows add up; an empty table adds nothing; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

FOLDER = "/opt/tokenizers"
# Fixed value: the published split pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, documents long, tokens long"


class Tokenizer(NamedTuple):
    """A vocabulary file of ranks. Its version is part of the name, so a changed file is another tokenizer."""

    name: str
    ranks: bytes

    @property
    def version(self) -> str:
        return f"{self.name}@{hashlib.sha256(self.ranks).hexdigest()[:12]}"


def read_tokenizer(name: str, folder: str = FOLDER) -> Tokenizer:
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return Tokenizer(name, f.read())


def encoding(name: str, ranks: bytes) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines())}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def _count_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encodings = [(version, encoding(version, ranks)) for version, ranks in shared.value]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for version, enc in encodings:
                counts = [len(enc.encode_ordinary(t.as_py() or "")) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                    ["doc_id", "source", "lang", "tokenizer", "tokens"],
                )

    return run


def count_tokens(docs: DataFrame, tokenizers: list[Tokenizer], text: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens), a row per document and tokenizer version."""
    shared = docs.sparkSession.sparkContext.broadcast([(t.version, t.ranks) for t in tokenizers])
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
    )
    return rows.mapInArrow(
        _count_batches(shared), "doc_id long, source string, lang string, tokenizer string, tokens long"
    )


def _summed(signed: DataFrame) -> DataFrame:
    return signed.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).filter(
        "documents <> 0 OR tokens <> 0"
    )


def insertions(counted: DataFrame) -> DataFrame:
    return _summed(counted.select(*KEYS, F.lit(1).cast("long").alias("documents"), "tokens"))


def deletions(counted: DataFrame) -> DataFrame:
    return _summed(counted.select(*KEYS, F.lit(-1).cast("long").alias("documents"), (-F.col("tokens")).alias("tokens")))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Deltas that lead from one set of counts to another: inserts, deletes and changed counts in one."""
    signed = after.withColumn("sign", F.lit(1)).unionByName(before.withColumn("sign", F.lit(-1)))
    return _summed(signed.select(
        *KEYS, F.col("sign").cast("long").alias("documents"), (F.col("sign") * F.col("tokens")).alias("tokens")
    ))


def commit(deltas: DataFrame, rollup: str, batch: str) -> None:
    """Store deltas as the named batch, in place of an earlier attempt at it. Groups are few, so one file holds them."""
    deltas.coalesce(1).write.mode("overwrite").parquet(f"{rollup.rstrip('/')}/batch={batch}")


def totals(spark: SparkSession, rollup: str) -> DataFrame:
    """(source, lang, tokenizer, documents, tokens) after all committed batches; groups that came to nothing are left out."""
    return _summed(spark.read.schema(f"{DELTA}, batch string").parquet(rollup))
