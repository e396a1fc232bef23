"""A corpus pipeline of five filtering stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of ``docs``; the
last returns the mix. ``run`` writes each stage to shared storage and reads it as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakeflow.llm import decontaminate, language_id, mixture, near_dups, secret_ledger
from stakeflow.llm.scratch import scratch_path, small_batches, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told: those without a letter.

    The posterior has to exceed one half, which any text with a few words passes.
    """
    named = {c: f"_{c}" for c in docs.columns if c in ("lang_pred", "score")}
    with small_batches(spark):  # for the counts, also where a stage is called on its own
        found = language_id.identify(docs.withColumnsRenamed(named))
    kept = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") > 0.5))
    return kept.drop("lang_pred", "score").withColumnsRenamed({v: k for k, v in named.items()}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dups.keep_one(docs, near_dups.near_duplicates(docs)).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_items(docs, items)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in whose text a secret was found."""
    ledger = scratch_path(spark, "ledger")
    secret_ledger.scan_increment(docs, ledger, "first")
    return secret_ledger.without_findings(docs, ledger)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words to take from each remaining document so that sources meet their targets."""
    return mixture.mix(docs)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mix", mix),
]

#: SQL can express neither the language model nor the passage index.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        # Python workers take a few thousand documents at a time, however long they are.
        with small_batches(spark):
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
