"""Documented report queries over the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stakeflow.functions.numeric import exact_sum, ratio


def _staking_rewards():
    return F.col("claimed_rewards") + F.col("unclaimed_change")


def earnings_per_period(earnings: DataFrame, unit: str = "day") -> DataFrame:
    """Earnings per validator and day, (Monday) week or month, newest first."""
    measures = [
        "claimed_rewards", "unclaimed_change", "priority_fees", "total_earned", "total_earned_usd"
    ]
    period = F.trunc("earning_date", unit) if unit != "day" else F.col("earning_date")
    return earnings.groupBy(period.alias("period"), "validator_id").agg(
        *[exact_sum(m).alias(m) for m in measures],
        F.sum("blocks_produced").alias("blocks_produced"),
    ).orderBy(F.col("period").desc(), "validator_id")


def reward_split(earnings: DataFrame) -> DataFrame:
    """Staking rewards and priority fees side by side."""
    return earnings.select(
        "earning_date", "validator_id", _staking_rewards().alias("staking_rewards"),
        "priority_fees", "total_earned",
    )


def token_totals(earnings: DataFrame) -> DataFrame:
    """Tokens earned per validator, largest first."""
    return earnings.groupBy("validator_id").agg(
        exact_sum("total_earned").alias("total_mon_earned"),
        exact_sum("priority_fees").alias("total_priority_fees"),
        exact_sum(_staking_rewards()).alias("total_staking_rewards"),
    ).orderBy(F.col("total_mon_earned").desc_nulls_last(), "validator_id")


def gross_revenue(earnings: DataFrame) -> DataFrame:
    """Monthly revenue per validator by source."""
    return earnings.groupBy(F.trunc("earning_date", "month").alias("month"), "validator_id").agg(
        exact_sum("total_earned").alias("gross_revenue_mon"),
        exact_sum("total_earned_usd").alias("gross_revenue_usd"),
        exact_sum("priority_fees").alias("priority_fee_revenue"),
        exact_sum(_staking_rewards()).alias("staking_revenue"),
    ).orderBy(F.col("month").desc(), "validator_id")


def priority_fees_per_day(fees: DataFrame) -> DataFrame:
    return fees.groupBy(F.to_date("block_timestamp").alias("fee_date"), "validator_id").agg(
        exact_sum("total_priority_fee").alias("priority_fees")
    )


def classified_transfers(
    transfers: DataFrame, wallet_map: DataFrame, validator_id: int
) -> DataFrame:
    """Transfers out of one validator's wallets, internal when they stay among them."""
    own = wallet_map.filter(F.col("validator_id") == validator_id).select("wallet_address").distinct()
    sent = transfers.join(
        own.withColumnRenamed("wallet_address", "from_address"), "from_address", "left_semi"
    )
    inside = own.select(F.col("wallet_address").alias("to_address"), F.lit(True).alias("_inside"))
    return sent.join(inside, "to_address", "left").select(
        "block_timestamp", "from_address", "to_address", "amount",
        F.when(F.col("_inside"), "internal").otherwise("external").alias("flow_type"),
    )


def wallets(validators: DataFrame, wallet_map: DataFrame) -> DataFrame:
    """Every validator with the wallets mapped to it."""
    return validators.select("validator_id", "auth_address", "consensus_address").join(
        wallet_map, "validator_id", "left"
    )


def epoch_performance_pct(performance: DataFrame) -> DataFrame:
    """Blocks produced as a percentage of the expectation."""
    pct = ratio("actual_blocks_produced", "expected_blocks_per_validator") * 100
    return performance.select(
        "epoch", "validator_id", "validator_stake", "stake_weight",
        "expected_blocks_per_validator", "actual_blocks_produced", "blocks_vs_expected",
        F.round(pct, 2).alias("performance_pct"),
    )


def validator_identity(validators: DataFrame) -> DataFrame:
    return validators.select(
        "validator_id", "validator_name", F.col("auth_address").alias("operator_address"),
        "consensus_address", F.col("created_at").alias("registration_date"),
        "initial_commission_pct", "current_commission_pct", "status",
    ).orderBy("validator_id")


# Columns and order of the plain listings.
LISTINGS: dict[str, tuple[list[str], list[str]]] = {
    "daily_earnings": (
        ["earning_date", "validator_id", "validator_name", "claimed_rewards", "unclaimed_change",
         "priority_fees", "blocks_produced", "total_earned", "total_earned_usd"],
        ["-earning_date", "validator_id"],
    ),
    "usd_value": (
        ["earning_date", "validator_id", "total_earned", "total_earned_usd", "priority_fees",
         "priority_fees_usd", "mon_price_usd"],
        ["-earning_date"],
    ),
    "reward_history": (
        ["earning_date", "validator_id", "claimed_rewards", "unclaimed_change", "priority_fees",
         "total_earned", "total_earned_usd", "unclaimed_balance"],
        ["-earning_date"],
    ),
    "apr": (
        ["validator_id", "validator_name", "earning_date", "apr_pct", "apy_pct",
         "apr_7d_rolling_pct", "apr_30d_rolling_pct"],
        ["-earning_date", "validator_id"],
    ),
    "block_production": (
        ["epoch", "validator_id", "validator_name", "blocks_produced", "total_block_rewards",
         "avg_reward_per_block", "first_block_timestamp", "last_block_timestamp"],
        ["-epoch", "-blocks_produced"],
    ),
    "block_fees": (
        ["block_number", "block_timestamp", "validator_id", "epoch", "miner", "tx_count",
         "tx_count_with_priority_fee", "total_gas_used", "total_priority_fee",
         "avg_priority_fee_per_gas", "base_fee_per_gas"],
        ["-block_number"],
    ),
    "epoch_performance": (
        ["epoch", "validator_id", "validator_name", "validator_stake", "total_epoch_stake",
         "stake_weight", "expected_blocks_per_validator", "actual_blocks_produced",
         "blocks_vs_expected", "pct_of_epoch_blocks", "expected_pct_of_epoch_blocks",
         "production_rank"],
        ["-epoch", "production_rank"],
    ),
    "wallet_balances": (
        ["balance_date", "validator_id", "validator_address", "balance", "balance_usd"],
        ["validator_id", "-balance_date"],
    ),
    "stake_snapshots": (
        ["snapshot_date", "validator_id", "execution_stake", "execution_stake_usd",
         "consensus_stake", "consensus_stake_usd"],
        ["validator_id", "-snapshot_date"],
    ),
    "flows": (
        ["flow_date", "validator_id", "delegator_address", "flow_type", "amount", "tx_count"],
        ["-flow_date"],
    ),
    "net_stake": (
        ["validator_id", "change_date", "delegations", "undelegations", "net_stake_change",
         "flow_direction", "cumulative_net_change"],
        ["-change_date"],
    ),
    "miss_rate": (
        ["epoch", "validator_id", "expected_blocks_per_validator", "actual_blocks_produced",
         "missed_blocks", "miss_rate_pct", "uptime_pct", "estimated_missed_commission_mon",
         "estimated_missed_commission_usd"],
        ["-epoch", "-miss_rate_pct"],
    ),
    "restart": (
        ["validator_id", "validator_name", "avg_daily_commission_mon",
         "missed_blocks_5min", "loss_usd_5min", "missed_blocks_15min", "loss_usd_15min",
         "missed_blocks_30min", "loss_usd_30min", "missed_blocks_1hr", "loss_usd_1hr"],
        ["-avg_daily_commission_mon"],
    ),
    "compound": (
        ["validator_id", "validator_name", "unclaimed_rewards", "unclaimed_rewards_usd",
         "current_price", "price_change_7d_pct", "price_change_30d_pct",
         "days_since_last_claim", "recommendation"],
        ["-unclaimed_rewards_usd"],
    ),
}


def listing(df: DataFrame, name: str) -> DataFrame:
    """One of the documented listings: fixed columns in a fixed order."""
    columns, order = LISTINGS[name]
    sort = [
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc() for c in order
    ]
    return df.select(*columns).orderBy(*sort)
