"""Epochs, block producers, priority fees, production against expectation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from stakeflow.functions.keys import surrogate_key
from stakeflow.functions.numeric import (
    RAW, WEI_PER_GWEI, WEI_PER_TOKEN, exact_avg, exact_sum, ratio, strict_extreme, tokens,
)
from stakeflow.functions.times import seconds_between
from stakeflow.operators import islands, next_values
from stakeflow.plans.validators import enrich
from stakeflow.sources.tables import producer_rewards

RANGE_KEY = ["validator_id", "miner", "start_block"]
RANGE_UPDATES = [
    "end_block", "end_timestamp", "blocks_produced", "duration_seconds", "is_current", "next_miner",
]


def dim_epochs(epoch_changes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Block range and times of every epoch; the open epoch ends at the last block."""
    starts = epoch_changes.select(
        F.col("new_epoch").alias("epoch"),
        F.col("block_number").alias("epoch_start_block"),
        F.col("block_timestamp").alias("epoch_start_timestamp"),
        F.col("tx_hash").alias("epoch_change_tx_hash"),
    )
    led = next_values(
        starts, [], "epoch",
        {"_next_block": "epoch_start_block", "epoch_end_timestamp": "epoch_start_timestamp"},
        width=10_000,
    )
    newest = blocks.agg(F.max("block_number")).scalar()
    ended = led.withColumn("epoch_end_block", F.coalesce(F.col("_next_block") - 1, newest))
    return ended.select(
        "epoch", "epoch_start_block", "epoch_end_block",
        (F.col("epoch_end_block") - F.col("epoch_start_block") + 1).alias("epoch_block_count"),
        "epoch_start_timestamp", "epoch_end_timestamp",
        seconds_between(F.col("epoch_start_timestamp"), F.col("epoch_end_timestamp"))
        .alias("epoch_duration_seconds"),
        "epoch_change_tx_hash",
    )


def _producer_blocks(rewards: DataFrame, blocks: DataFrame) -> DataFrame:
    return producer_rewards(rewards).select(
        "block_number", "block_timestamp", "validator_id"
    ).join(blocks.select("block_number", "miner"), "block_number")


def _published_ranges(ranges: DataFrame) -> DataFrame:
    return ranges.select(
        "validator_id", "miner",
        F.col("start").alias("start_block"), F.col("end").alias("end_block"),
        F.col("start_ts").alias("start_timestamp"), F.col("end_ts").alias("end_timestamp"),
        F.col("n").alias("blocks_produced"),
        seconds_between(F.col("start_ts"), F.col("end_ts")).alias("duration_seconds"),
        "is_current", F.col("next_value").alias("next_miner"),
        surrogate_key("validator_id", "miner", F.col("start")).alias("dim_miner_validators_id"),
    )


def dim_miner_validators(rewards: DataFrame, blocks: DataFrame) -> DataFrame:
    """Ranges of consecutive blocks a validator produced with one miner address."""
    found = islands(
        _producer_blocks(rewards, blocks), "validator_id", "block_number", "miner",
        "block_timestamp",
    )
    return _published_ranges(found)


def dim_miner_validators_increment(
    current: DataFrame, new_rewards: DataFrame, rewards: DataFrame, blocks: DataFrame
) -> DataFrame:
    """The range table after ``new_rewards``; equal to a rebuild from ``rewards``.

    A validator's open range is one row in front of its new blocks. Validators with
    a reward for a block inside published ranges are rebuilt from ``rewards``, which
    has to hold the new rows as well.
    """
    fresh = producer_rewards(new_rewards)
    ends = current.groupBy("validator_id").agg(F.max("end_block").alias("_end"))
    # One row per validator of the batch.
    touched = fresh.groupBy("validator_id").agg(F.min("block_number").alias("_from")).join(
        ends, "validator_id", "left"
    ).select(
        "validator_id", F.coalesce(F.col("_from") <= F.col("_end"), F.lit(False)).alias("_late")
    )
    late = touched.filter("_late").select("validator_id")

    held = current.join(touched, "validator_id", "left")
    kept = held.filter(
        F.col("_late").isNull() | (~F.col("_late") & ~F.col("is_current"))
    ).select(*current.columns)
    opened = held.filter(~F.col("_late") & F.col("is_current")).select(
        *RANGE_KEY, "end_block", "start_timestamp", "end_timestamp",
        F.col("blocks_produced").alias("n"),
    )
    again = _producer_blocks(
        fresh.join(late, "validator_id", "left_anti").select(*rewards.columns).unionByName(
            rewards.join(late, "validator_id", "left_semi")
        ),
        blocks,
    )
    single = again.select(
        "validator_id", "miner",
        F.col("block_number").alias("start_block"), F.col("block_number").alias("end_block"),
        F.col("block_timestamp").alias("start_timestamp"),
        F.col("block_timestamp").alias("end_timestamp"), F.lit(1).cast("bigint").alias("n"),
    )
    ranges = _published_ranges(islands(
        opened.unionByName(single), "validator_id", "start_block", "miner", "start_timestamp",
        end="end_block", end_ts="end_timestamp", count="n",
    ))
    return kept.select(*ranges.columns).unionByName(ranges)


def fact_block_priority_fees(
    transactions: DataFrame, blocks: DataFrame, rewards: DataFrame
) -> DataFrame:
    """Fees above the base fee, per block, with the producing validator.

    Prices become integer wei per transaction, so block sums are exact. All three
    inputs meet on block_number.
    """
    base = F.col("base_fee_per_gas").cast(RAW)
    # A price in wei per gas fits 64 bits; a fee or a sum of prices may not.
    over = F.rint(F.col("effective_gas_price") * WEI_PER_GWEI).cast("bigint") - base.cast("bigint")
    paid = transactions.select(
        "block_number", "block_timestamp", "gas_used", "effective_gas_price"
    ).join(
        blocks.select("block_number", "miner", "base_fee_per_gas"), "block_number"
    ).withColumn("_over", over.cast("decimal(18,0)")).withColumn(
        "_fee", F.col("_over") * F.col("gas_used").cast("decimal(18,0)")
    )
    per_block = paid.groupBy("block_number", "block_timestamp", "miner", "base_fee_per_gas").agg(
        F.count("*").alias("tx_count"),
        F.count_if(F.col("_fee") > 0).alias("tx_count_with_priority_fee"),
        F.sum("gas_used").alias("total_gas_used"),
        F.sum("_fee").alias("_fees"),
        F.sum("_over").alias("_sum_over"),
        F.count("_over").alias("_n_over"),
        F.min("_over").alias("_min_over"),
        F.max("_over").alias("_max_over"),
    )
    producers = producer_rewards(rewards).select("block_number", "validator_id", "epoch")

    def gas_price(wei):
        return wei.cast("double") / WEI_PER_GWEI / WEI_PER_GWEI

    return per_block.join(producers, "block_number", "left").select(
        "block_number", "block_timestamp", "validator_id", "epoch", "miner",
        (base.cast("double") / WEI_PER_GWEI).alias("base_fee_per_gas"),
        "tx_count", "tx_count_with_priority_fee", "total_gas_used",
        (F.col("_fees").cast("double") / WEI_PER_TOKEN).alias("total_priority_fee"),
        (F.col("_sum_over").cast("double") / F.col("_n_over") / WEI_PER_GWEI / WEI_PER_GWEI)
        .alias("avg_priority_fee_per_gas"),
        gas_price(F.col("_min_over")).alias("min_priority_fee_per_gas"),
        gas_price(F.col("_max_over")).alias("max_priority_fee_per_gas"),
        surrogate_key("block_number").alias("fact_block_priority_fees_id"),
    )


def fact_block_priority_fees_increment(
    transactions: DataFrame, blocks: DataFrame, rewards: DataFrame, since: dt.datetime,
    new_rewards: DataFrame | None = None,
) -> DataFrame:
    """Whole recomputed rows for every block with a transaction newer than ``since`` or a new reward.

    The touched blocks enter the scans as a list of their days and as their block range, both literals: an old
    late transaction next to today's adds one day to read, not every day in between. The blocks themselves then
    meet the sources in a semi join, which the planner can turn into a runtime filter.
    """
    mark = F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")
    touched = transactions.filter(F.col("modified_timestamp") > mark).select("block_number", "block_timestamp")
    if new_rewards is not None:
        touched = touched.unionByName(producer_rewards(new_rewards).select("block_number", "block_timestamp"))
    # One row per day: at most the days of the history, whatever the number of transactions.
    found = touched.groupBy(_day(touched).alias("day")).agg(
        F.min("block_number").alias("low"), F.max("block_number").alias("high")
    ).collect()
    days = [r["day"] for r in found]
    low, high = min((r["low"] for r in found), default=None), max((r["high"] for r in found), default=None)

    def within(df: DataFrame) -> DataFrame:
        dated = "block_date" in df.columns or "block_timestamp" in df.columns
        inside = F.col("block_number").between(F.lit(low), F.lit(high))
        return df.filter(inside & _day(df).isin(days) if dated else inside).join(blocks_touched, "block_number", "left_semi")

    blocks_touched = touched.select("block_number").distinct()
    return fact_block_priority_fees(within(transactions), within(blocks), within(rewards))


def _day(df: DataFrame) -> Column:
    # Stored tables are partitioned by this column, so a list of days prunes folders.
    return F.col("block_date") if "block_date" in df.columns else F.to_date("block_timestamp")


def ez_block_production(rewards: DataFrame, validators: DataFrame | None = None) -> DataFrame:
    """Blocks and rewards per validator and epoch."""
    produced = producer_rewards(rewards).groupBy("epoch", "validator_id").agg(
        F.count("*").alias("blocks_produced"),
        F.sum("amount_raw").alias("total_block_rewards_raw"),
        F.min("block_number").alias("first_block_produced"),
        F.max("block_number").alias("last_block_produced"),
        F.min("block_timestamp").alias("first_block_timestamp"),
        F.max("block_timestamp").alias("last_block_timestamp"),
    ).withColumn("total_block_rewards", tokens("total_block_rewards_raw"))
    owner = []
    if validators is not None:
        auth = validators.select("validator_id", "auth_address")
        produced = produced.join(auth, "validator_id", "left")
        owner = ["auth_address"]
    out = produced.select(
        "epoch", "validator_id", *owner, "blocks_produced", "total_block_rewards",
        "total_block_rewards_raw",
        (F.col("total_block_rewards") / F.col("blocks_produced")).alias("avg_reward_per_block"),
        "first_block_produced", "last_block_produced",
        "first_block_timestamp", "last_block_timestamp",
        surrogate_key("epoch", "validator_id").alias("ez_block_production_id"),
    )
    return enrich(out, validators)


def validator_epoch_stakes(
    validator_set: DataFrame, created: DataFrame, epochs: DataFrame, snapshots: DataFrame
) -> DataFrame:
    """Set members with their stake at epoch start.

    Snapshots are end-of-day, so the previous day's counts; else the same day's;
    else zero. Epochs that began before the validator was created are left out.
    """
    members = validator_set.select("epoch", "validator_id", "validator_position").join(
        created.select(
            "validator_id", F.col("auth_address").alias("validator_address"),
            F.col("block_timestamp").alias("created_at"),
        ),
        "validator_id",
    ).join(
        epochs.select(
            "epoch", F.col("epoch_block_count").alias("total_epoch_blocks"),
            "epoch_start_timestamp", "epoch_end_timestamp",
        ),
        "epoch",
    ).filter(F.col("epoch_start_timestamp") >= F.col("created_at"))
    # Both candidate days arrive through one join: a snapshot serves its own day
    # and, as the better choice, the day after.
    served = snapshots.select(
        "validator_id",
        F.explode(F.array(
            F.struct(F.date_add("snapshot_date", 1).alias("_day"), F.col("snapshot_stake").alias("_prev"), F.lit(None).cast("double").alias("_same")),
            F.struct(F.col("snapshot_date").alias("_day"), F.lit(None).cast("double").alias("_prev"), F.col("snapshot_stake").alias("_same")),
        )).alias("_s"),
    ).select("validator_id", "_s.*").groupBy("validator_id", "_day").agg(
        F.coalesce(F.max("_prev"), F.max("_same")).alias("_stake")
    )
    return members.withColumn("_day", F.to_date("epoch_start_timestamp")).join(
        served, ["validator_id", "_day"], "left"
    ).select(
        "epoch", "validator_id", "validator_position", "validator_address",
        "total_epoch_blocks", "epoch_start_timestamp", "epoch_end_timestamp",
        F.coalesce("_stake", F.lit(0.0)).alias("validator_stake"),
    )


def ez_validator_epoch_performance(
    validator_set: DataFrame, created: DataFrame, epochs: DataFrame, snapshots: DataFrame,
    production: DataFrame, validators: DataFrame | None = None,
) -> DataFrame:
    """Blocks produced against the stake-weighted expectation, per validator and epoch."""
    stakes = validator_epoch_stakes(validator_set, created, epochs, snapshots)
    made = production.select(
        "epoch", "validator_id", F.col("blocks_produced").alias("actual_blocks_produced"),
        "total_block_rewards", "avg_reward_per_block",
    )
    # One row per epoch and set member, so a partition is one validator set.
    in_epoch = Window.partitionBy("epoch")
    joined = stakes.join(made, ["epoch", "validator_id"], "left").na.fill(
        0, ["actual_blocks_produced", "total_block_rewards", "avg_reward_per_block"]
    ).withColumns({
        "total_epoch_stake": exact_sum("validator_stake", in_epoch),
        "validators_in_snapshot": F.count("validator_id").over(in_epoch),
    })
    share = ratio("validator_stake", "total_epoch_stake")
    blocks_, actual = F.col("total_epoch_blocks"), F.col("actual_blocks_produced")
    by_blocks = in_epoch.orderBy(F.col("actual_blocks_produced").desc())
    out = joined.select(
        "epoch", "validator_id", "validator_position", "validator_address",
        "validators_in_snapshot", "total_epoch_blocks", "validator_stake", "total_epoch_stake",
        F.round(share, 6).alias("stake_weight"),
        F.round(blocks_ * share, 2).alias("expected_blocks_per_validator"),
        "actual_blocks_produced",
        (actual - F.round(blocks_ * share, 0)).alias("blocks_vs_expected"),
        F.round(F.lit(100.0) * actual / F.nullif(blocks_, F.lit(0)), 4)
        .alias("pct_of_epoch_blocks"),
        F.round(ratio(F.lit(100.0) * F.col("validator_stake"), "total_epoch_stake"), 4)
        .alias("expected_pct_of_epoch_blocks"),
        F.rank().over(by_blocks).alias("production_rank"),
        "total_block_rewards", "avg_reward_per_block",
        "epoch_start_timestamp", "epoch_end_timestamp",
        surrogate_key("epoch", "validator_id").alias("ez_validator_epoch_performance_id"),
    )
    return enrich(out, validators)


def latest_price(prices: DataFrame):
    """The newest native price as a scalar, zero when there is none."""
    newest = F.max_by("price", "hour")
    return prices.filter("is_native").agg(F.coalesce(newest, F.lit(0.0))).scalar()


def ez_miss_rate(
    performance: DataFrame, earnings: DataFrame, prices: DataFrame,
    validators: DataFrame | None = None,
) -> DataFrame:
    """Missed blocks, uptime and the commission they cost, per validator and epoch."""
    daily = earnings.groupBy("validator_id").agg(
        exact_avg("total_earned").alias("avg_daily_commission_mon")
    )
    expected, actual = F.col("expected_blocks_per_validator"), F.col("actual_blocks_produced")
    due = expected > 0
    missed = strict_extreme(F.greatest, expected - actual, F.lit(0.0))
    uptime = strict_extreme(F.least, ratio(actual, expected), F.lit(1.0))
    lost = ratio(missed, expected) * F.coalesce("avg_daily_commission_mon", F.lit(0.0))
    joined = performance.join(daily, "validator_id", "left").withColumn(
        "mon_price_usd", latest_price(prices)
    )
    out = joined.select(
        "epoch", "validator_id", "validator_address", "validators_in_snapshot",
        "total_epoch_blocks", "expected_blocks_per_validator", "actual_blocks_produced",
        "blocks_vs_expected", "pct_of_epoch_blocks", "production_rank",
        missed.alias("missed_blocks"),
        F.when(due, F.round(ratio(missed, expected) * 100, 2)).otherwise(0.0).alias("miss_rate_pct"),
        F.when(due, F.round(uptime * 100, 2)).otherwise(100.0).alias("uptime_pct"),
        "avg_daily_commission_mon",
        F.when(due, F.round(lost, 4)).otherwise(0.0).alias("estimated_missed_commission_mon"),
        F.when(due, F.round(lost * F.col("mon_price_usd"), 2)).otherwise(0.0)
        .alias("estimated_missed_commission_usd"),
        "mon_price_usd", "epoch_start_timestamp", "epoch_end_timestamp",
        surrogate_key("epoch", "validator_id").alias("ez_miss_rate_id"),
    )
    return enrich(out, validators)
