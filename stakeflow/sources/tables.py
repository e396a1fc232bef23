"""Scans: tables by name, seed files, the date spine, literal rows, staking events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakeflow.sources.contracts import CONTRACTS, conform

# The staking precompile and the selector of its block-reward call.
STAKING_CONTRACT = "0x0000000000000000000000000000000000001000"
REWARD_SELECTOR = "0x791bdcf3"


def read_table(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A named relation, from ``path`` (Parquet) or the session catalog, contract-checked."""
    df = spark.read.parquet(path) if path else spark.table(name)
    short = name.rsplit(".", 1)[-1]
    return conform(df, short) if short in CONTRACTS else df


def read_seed(spark: SparkSession, path: str, name: str = "validator_locations") -> DataFrame:
    """A seed CSV with a header, quoted fields, and empty fields as NULL."""
    return spark.read.csv(
        path, schema=CONTRACTS[name], header=True, quote='"', escape='"', emptyValue=None,
        nullValue="", enforceSchema=False, mode="FAILFAST",
    )


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from start to end."""
    days = F.sequence(F.lit(start), F.lit(end))
    return spark.range(1, numPartitions=1).select(F.explode(days).alias("date_day"))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of literal rows, such as page offsets."""
    return spark.createDataFrame(list(rows), schema)


def staking_events(logs: DataFrame, contract: str = STAKING_CONTRACT) -> DataFrame:
    """Successful logs of one contract."""
    return logs.filter((F.col("contract_address") == contract) & F.col("tx_succeeded"))


def producer_rewards(rewards: DataFrame) -> DataFrame:
    """Reward events that mark the producer of a block."""
    return rewards.filter(
        (F.col("origin_to_address") == STAKING_CONTRACT)
        & (F.col("origin_function_signature") == REWARD_SELECTOR)
    )
