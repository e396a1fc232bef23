"""Validator earnings, APR and APY."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stakeflow.functions.keys import surrogate_key
from stakeflow.functions.numeric import RAW, exact_avg, exact_sum, tokens
from stakeflow.plans.validators import enrich


def own_claims(claims: DataFrame, created: DataFrame) -> DataFrame:
    """Claims a validator's own address made on that validator."""
    owners = created.select(
        "validator_id", F.lower("auth_address").alias("_owner")
    ).distinct()
    return claims.withColumn("_owner", F.lower("delegator_address")).join(
        owners, ["validator_id", "_owner"], "left_semi"
    )


def ez_validator_earnings(
    self_snapshots: DataFrame, claims: DataFrame, created: DataFrame, fees: DataFrame,
    validators: DataFrame | None = None,
) -> DataFrame:
    """Claims plus change in unclaimed rewards plus priority fees, per validator and day.

    The change is against the previous snapshot, however old; the first one has
    nothing to compare with and is dropped.
    """
    # One snapshot per validator and day.
    by_day = Window.partitionBy("validator_id").orderBy("snapshot_date")
    days = self_snapshots.select(
        "validator_id", "snapshot_date", F.col("stake").alias("self_stake"),
        "unclaimed_rewards", "unclaimed_rewards_usd", "mon_price_usd",
        F.lag("unclaimed_rewards").over(by_day).alias("prev_unclaimed"),
        F.lag("snapshot_date").over(by_day).alias("prev_snapshot_date"),
    ).filter(F.col("prev_unclaimed").isNotNull())
    claimed = own_claims(claims, created).groupBy(
        "validator_id", F.to_date("block_timestamp").alias("snapshot_date")
    ).agg(F.sum("amount_raw").alias("claimed_raw"), F.count("*").alias("claim_count"))
    paid = fees.filter(F.col("validator_id").isNotNull()).groupBy(
        "validator_id", F.to_date("block_timestamp").alias("snapshot_date")
    ).agg(
        exact_sum("total_priority_fee").alias("priority_fees"),
        F.count("*").alias("blocks_produced"),
    )
    keys = ["validator_id", "snapshot_date"]
    joined = days.join(claimed, keys, "left").join(paid, keys, "left").withColumns({
        "claimed_rewards_raw": F.coalesce("claimed_raw", F.lit(0).cast(RAW)),
        "claim_count": F.coalesce("claim_count", F.lit(0).cast("bigint")),
        "priority_fees": F.coalesce("priority_fees", F.lit(0.0)),
        "blocks_produced": F.coalesce("blocks_produced", F.lit(0).cast("bigint")),
        "unclaimed_change": F.col("unclaimed_rewards") - F.col("prev_unclaimed"),
    }).withColumn("claimed_rewards", tokens("claimed_rewards_raw"))
    earned = joined.withColumn(
        "total_earned",
        F.col("claimed_rewards") + F.col("unclaimed_change") + F.col("priority_fees"),
    )
    price = F.col("mon_price_usd")
    out = earned.select(
        "validator_id", F.col("snapshot_date").alias("earning_date"), "self_stake",
        "claimed_rewards", "claimed_rewards_raw", "claim_count", "unclaimed_change",
        "priority_fees", "blocks_produced", "total_earned",
        F.col("unclaimed_rewards").alias("unclaimed_balance"),
        F.col("unclaimed_rewards_usd").alias("unclaimed_balance_usd"),
        "mon_price_usd",
        (F.col("total_earned") * price).alias("total_earned_usd"),
        (F.col("priority_fees") * price).alias("priority_fees_usd"),
        "prev_snapshot_date",
        surrogate_key("validator_id", "snapshot_date").alias("ez_validator_earnings_id"),
    )
    return enrich(out, validators)


def ez_validator_apr(
    earnings: DataFrame, snapshots: DataFrame, validators: DataFrame | None = None
) -> DataFrame:
    """Daily and rolling yield on execution stake; frames count rows, not days."""
    staked = snapshots.filter(F.col("execution_stake") > 0).select(
        "validator_id", F.col("snapshot_date").alias("earning_date"), "execution_stake",
        "execution_stake_usd",
    )
    daily = earnings.select(
        "validator_id", "earning_date", "total_earned", "total_earned_usd", "mon_price_usd"
    ).join(staked, ["validator_id", "earning_date"]).withColumn(
        "daily_return_rate", F.col("total_earned") / F.col("execution_stake")
    )
    rate = F.col("daily_return_rate")
    # One row per validator and day.
    by_day = Window.partitionBy("validator_id").orderBy("earning_date")

    def rolling(n: int):
        mean = exact_avg("daily_return_rate", by_day.rowsBetween(1 - n, 0))
        return F.round(mean * 365 * 100, 4)

    out = daily.select(
        "validator_id", "earning_date", "total_earned", "total_earned_usd",
        "execution_stake", "execution_stake_usd", "mon_price_usd", "daily_return_rate",
        F.round(rate * 365 * 100, 4).alias("apr_pct"),
        F.round((F.pow(rate + 1, F.lit(365.0)) - 1) * 100, 4).alias("apy_pct"),
        rolling(7).alias("apr_7d_rolling_pct"),
        rolling(30).alias("apr_30d_rolling_pct"),
        surrogate_key("validator_id", "earning_date").alias("ez_validator_apr_id"),
    )
    return enrich(out, validators)
