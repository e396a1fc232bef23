"""Operator decision data: restart impact, compound or sell."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from stakeflow.functions.keys import surrogate_key
from stakeflow.functions.numeric import exact_avg, exact_sum, ratio, tokens
from stakeflow.functions.times import as_timestamp, days_between, ntz
from stakeflow.plans.blocks import latest_price
from stakeflow.plans.earnings import own_claims
from stakeflow.plans.validators import enrich

# Column suffix per restart length, and the recommendation texts.
RESTARTS = {5: "5min", 15: "15min", 30: "30min", 60: "1hr"}
SELL = "Consider selling - price up 20%+ from 30d avg"
COMPOUND = "Consider compounding - price down 20%+ from 30d avg"
PRICE = "decimal(19,9)"
PARTIAL = "High volatility - consider partial claim"
CLAIM = "Large balance accumulated - consider claiming"
NEUTRAL = "Neutral - compound or hold based on cash needs"


def ez_restart_impact(
    performance: DataFrame, epochs: DataFrame, earnings: DataFrame, prices: DataFrame,
    validators: DataFrame | None = None, *, as_of: dt.date,
    minutes: tuple[int, ...] = (5, 15, 30, 60),
) -> DataFrame:
    """Blocks and commission a validator loses to a restart of given length.

    Based on epochs from ten before the latest one, and 30 days of earnings.
    """
    recent_from = performance.agg(F.max("epoch") - 10)
    recent = performance.filter(F.col("epoch") >= recent_from.scalar())
    stats = recent.groupBy(
        "validator_id", F.col("validator_address").alias("auth_address")
    ).agg(
        F.avg("actual_blocks_produced").alias("avg_blocks_per_epoch"),
        exact_avg("pct_of_epoch_blocks").alias("avg_pct_share"),
        exact_avg("total_block_rewards").alias("avg_rewards_per_epoch"),
        F.count("*").alias("epochs_analyzed"),
    )
    typical = epochs.join(recent.select("epoch").distinct(), "epoch", "left_semi").filter(
        (F.col("epoch_duration_seconds") > 0) & (F.col("epoch_block_count") > 0)
    ).agg(
        F.struct(
            F.avg("epoch_block_count").alias("blocks"),
            F.avg("epoch_duration_seconds").alias("seconds"),
        )
    )
    daily = earnings.filter(F.col("earning_date") >= F.lit(as_of - dt.timedelta(days=30))).groupBy(
        "validator_id"
    ).agg(exact_avg("total_earned").alias("avg_daily_commission_mon"))

    joined = stats.join(daily, "validator_id", "left").withColumns({
        "_typical": typical.scalar(),
        "mon_price_usd": latest_price(prices),
    })
    commission = F.coalesce("avg_daily_commission_mon", F.lit(0.0))
    seconds = F.nullif(F.col("_typical.seconds"), F.lit(0.0))
    estimates = []
    for m in minutes:
        suffix = RESTARTS.get(m, f"{m}min")
        lost = commission * F.lit(float(m) / 1440)
        estimates += [
            F.round(F.lit(60.0 * m) / seconds * F.col("avg_blocks_per_epoch"))
            .alias(f"missed_blocks_{suffix}"),
            F.round(lost, 6).alias(f"loss_mon_{suffix}"),
            F.round(lost * F.coalesce("mon_price_usd", F.lit(0.0)), 2).alias(f"loss_usd_{suffix}"),
        ]
    out = joined.select(
        "validator_id", "auth_address", "avg_blocks_per_epoch", "avg_pct_share",
        "avg_rewards_per_epoch", "epochs_analyzed",
        F.col("_typical.blocks").alias("avg_epoch_blocks"),
        F.col("_typical.seconds").alias("avg_epoch_seconds"),
        "avg_daily_commission_mon", "mon_price_usd", *estimates,
        surrogate_key("validator_id").alias("ez_restart_impact_id"),
    )
    return enrich(out, validators)


def units(price):
    """A price as a whole number of 1e-9 units, exact in decimal(38,0) for sums of squares of 30 days."""
    return (price.cast(PRICE) * F.lit(1_000_000_000)).cast("decimal(38,0)")


def price_trend(prices: DataFrame, as_of: dt.date | dt.datetime) -> DataFrame:
    """One row of 1, 7 and 30 day price statistics, from a single pruned scan."""
    now = as_timestamp(as_of)

    def within(days: int):
        return F.when(F.col("hour") >= ntz(now - dt.timedelta(days=days)), F.col("price"))

    month = prices.filter(F.col("is_native") & (F.col("hour") >= ntz(now - dt.timedelta(days=30))))
    return month.agg(
        exact_avg(within(1)).alias("price_1d_avg"),
        exact_avg(within(7)).alias("price_7d_avg"),
        exact_avg(within(30)).alias("price_30d_avg"),
        F.min(within(30)).alias("price_30d_low"),
        F.max(within(30)).alias("price_30d_high"),
        F.count(within(30)).alias("_n"),
        F.sum(units(within(30))).alias("_sum"),
        F.sum(units(within(30)) * units(within(30))).alias("_squares"),
    ).withColumn(
        # n * (sum of squares) - sum^2 is taken on whole numbers of 1e-9 price units, so it neither depends
        # on the order of rows nor cancels digits away when prices are large and close together (decimal
        # products with a scale would be narrowed by Spark); only the quotient and its root are doubles.
        "price_volatility_30d",
        F.when(F.col("_n") > 1, F.sqrt(F.greatest(
            F.lit(0.0), (F.col("_squares") * F.col("_n") - F.col("_sum") * F.col("_sum")).cast("double")
        ) / (F.col("_n") * (F.col("_n") - 1))) / F.lit(1e9)),
    ).drop("_n", "_sum", "_squares")


def ez_compound_decision(
    self_snapshots: DataFrame, prices: DataFrame, claims: DataFrame, created: DataFrame,
    earnings: DataFrame, validators: DataFrame | None = None, *, as_of: dt.date | dt.datetime,
) -> DataFrame:
    """Unclaimed balance, price trend and claim habits behind a rule-based hint."""
    now = as_timestamp(as_of)
    today = now.date()
    month_ago = today - dt.timedelta(days=30)
    newest = self_snapshots.agg(F.max("snapshot_date")).scalar()
    latest = self_snapshots.filter(F.col("snapshot_date") == newest).select(
        "validator_id", "snapshot_date", "unclaimed_rewards", "unclaimed_rewards_usd",
        F.col("mon_price_usd").alias("current_price"),
    )
    recent = own_claims(
        claims.filter(F.col("block_timestamp") >= ntz(month_ago)), created
    ).groupBy("validator_id").agg(
        F.count("*").alias("claims_last_30d"),
        tokens(F.sum("amount_raw")).alias("claimed_amount_30d"),
        F.max("block_timestamp").alias("last_claim_timestamp"),
    )
    earned = earnings.filter(F.col("earning_date") >= F.lit(month_ago)).groupBy(
        "validator_id"
    ).agg(
        exact_sum("total_earned").alias("earnings_30d"),
        exact_avg("total_earned").alias("_avg_earned"),
    )
    trend = price_trend(prices, now)
    joined = (
        latest.join(recent, "validator_id", "left").join(earned, "validator_id", "left")
        .withColumn("_trend", trend.select(F.struct(*trend.columns)).scalar())
        .select("*", "_trend.*")
    )
    price, mean = F.col("current_price"), F.col("price_30d_avg")
    drift = ratio(price - mean, mean)
    hint = (
        F.when(drift > 0.2, SELL)
        .when(drift < -0.2, COMPOUND)
        .when(F.col("price_volatility_30d") > mean * 0.1, PARTIAL)
        .when(ratio("unclaimed_rewards", "_avg_earned") > 30, CLAIM)
        .otherwise(NEUTRAL)
    )
    week = F.col("price_7d_avg")
    out = joined.select(
        "validator_id", "snapshot_date", "unclaimed_rewards", "unclaimed_rewards_usd",
        "current_price", "price_1d_avg", "price_7d_avg", "price_30d_avg", "price_30d_low",
        "price_30d_high", "price_volatility_30d",
        F.round(ratio(price - week, week) * 100, 2).alias("price_change_7d_pct"),
        F.round(drift * 100, 2).alias("price_change_30d_pct"),
        F.coalesce("claims_last_30d", F.lit(0).cast("bigint")).alias("claims_last_30d"),
        F.coalesce("claimed_amount_30d", F.lit(0.0)).alias("claimed_amount_30d"),
        "last_claim_timestamp",
        days_between(F.col("last_claim_timestamp"), ntz(now)).alias("days_since_last_claim"),
        F.coalesce("earnings_30d", F.lit(0.0)).alias("earnings_30d"),
        F.coalesce("_avg_earned", F.lit(0.0)).alias("avg_daily_earnings"),
        F.when(
            F.col("_avg_earned") > 0,
            F.round(ratio("unclaimed_rewards", "_avg_earned"), 1),
        ).alias("days_of_earnings_accumulated"),
        hint.alias("recommendation"),
        surrogate_key("validator_id", "snapshot_date").alias("ez_compound_decision_id"),
    )
    return enrich(out, validators)
