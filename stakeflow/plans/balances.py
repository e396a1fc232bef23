"""Stake flows and balances per delegator and validator, wallet balances."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from stakeflow.functions.keys import surrogate_key
from stakeflow.functions.numeric import RAW, clamped_tokens, exact_sum, micro, ratio, tokens, usd
from stakeflow.operators import asof_join, hold_until_next
from stakeflow.plans.snapshots import with_close_price
from stakeflow.plans.validators import enrich

PAIR = ["validator_id", "delegator_address"]
SPARSE_HOURS = 24 * 90
SHOWN = (
    "active_balance <> 0 OR pending_withdrawal_balance <> 0 "
    "OR daily_active_change <> 0 OR daily_pending_change <> 0"
)


def ez_net_stake_changes(
    delegations: DataFrame, undelegations: DataFrame, validators: DataFrame | None = None
) -> DataFrame:
    """Daily delegated, undelegated and net stake per validator, with the running net.

    The two sides are stacked and grouped once, which yields the rows of a full
    outer join of two aggregates with a single shuffle.
    """
    sides = delegations.select(
        "validator_id", "block_timestamp", "amount_raw", F.lit(True).alias("is_in")
    ).unionByName(
        undelegations.select(
            "validator_id", "block_timestamp", "amount_raw", F.lit(False).alias("is_in")
        )
    )
    inflow, outflow = F.col("is_in"), ~F.col("is_in")
    zero = F.lit(0).cast(RAW)
    daily = sides.groupBy("validator_id", F.to_date("block_timestamp").alias("change_date")).agg(
        F.coalesce(F.sum(F.when(inflow, F.col("amount_raw"))), zero).alias("delegations_raw"),
        F.count_if(inflow).alias("delegation_count"),
        F.coalesce(F.sum(F.when(outflow, F.col("amount_raw"))), zero).alias("undelegations_raw"),
        F.count_if(outflow).alias("undelegation_count"),
    )
    # At most one row per validator and day from here on.
    running = (
        Window.partitionBy("validator_id").orderBy("change_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    net = (F.col("delegations_raw") - F.col("undelegations_raw")).cast(RAW)
    out = daily.select(
        "validator_id", "change_date",
        tokens("delegations_raw").alias("delegations"), "delegations_raw", "delegation_count",
        tokens("undelegations_raw").alias("undelegations"), "undelegations_raw",
        "undelegation_count",
        tokens(net).alias("net_stake_change"), net.alias("net_stake_change_raw"),
        F.when(net > 0, "net_inflow").when(net < 0, "net_outflow").otherwise("neutral")
        .alias("flow_direction"),
        tokens(F.sum(net).over(running)).alias("cumulative_net_change"),
        surrogate_key("validator_id", "change_date").alias("ez_net_stake_changes_id"),
    )
    return enrich(out, validators)


def ez_staking_flows_daily(
    delegations: DataFrame, undelegations: DataFrame, withdrawals: DataFrame, claims: DataFrame,
    validators: DataFrame | None = None,
) -> DataFrame:
    """Daily amounts and counts per validator, delegator and kind of flow."""
    tagged = [
        df.select(*PAIR, "block_timestamp", "amount_raw", F.lit(kind).alias("flow_type"))
        for kind, df in [
            ("delegation", delegations), ("undelegation", undelegations),
            ("withdrawal", withdrawals), ("claim", claims),
        ]
    ]
    flows = tagged[0]
    for more in tagged[1:]:
        flows = flows.unionByName(more)
    keys = ["flow_date", *PAIR, "flow_type"]
    daily = flows.withColumn("flow_date", F.to_date("block_timestamp")).groupBy(*keys).agg(
        F.sum("amount_raw").alias("amount_raw"), F.count("*").alias("tx_count")
    )
    out = daily.select(
        *keys, tokens("amount_raw").alias("amount"), "amount_raw", "tx_count",
        surrogate_key(*keys).alias("ez_staking_flows_daily_id"),
    )
    return enrich(out, validators)


def matched_withdrawals(withdrawals: DataFrame, undelegations: DataFrame) -> DataFrame:
    """Withdrawals with the amount of the undelegation they complete.

    Withdraw ids are reused, so it is the latest undelegation strictly before the
    withdrawal. The withdrawal's own amount includes rewards and is the fallback.
    """
    matched = asof_join(
        withdrawals.select(*PAIR, "withdraw_id", "block_timestamp", "amount_raw"),
        undelegations,
        keys=[*PAIR, "withdraw_id"],
        left_ts="block_timestamp",
        right_ts="block_timestamp",
        right_cols={"undelegated_raw": "amount_raw"},
        right_tie=["block_number", "event_index"],
        # A withdraw id is used a few times in its life, so a narrow span would hold single rows.
        width=SPARSE_HOURS,
    )
    return matched.withColumn("settled_raw", F.coalesce("undelegated_raw", "amount_raw"))


def daily_stake_changes(
    delegations: DataFrame, undelegations: DataFrame, withdrawals: DataFrame,
    until: dt.date, since: dt.date | None = None,
) -> DataFrame:
    """Raw active and pending changes per day and pair, rounded to the sixth decimal.

    Days after ``since`` and up to ``until``. Undelegations before ``since`` still
    serve as matches. Both bounds reach the scans.
    """
    def day_of(df: DataFrame) -> Column:
        # Stored facts are partitioned by this column, so a bound on it prunes folders.
        return F.col("block_date") if "block_date" in df.columns else F.to_date("block_timestamp")

    def known(df: DataFrame) -> DataFrame:
        return df.filter(day_of(df) <= F.lit(until))

    def later(df: DataFrame) -> DataFrame:
        return known(df).filter(day_of(df) > F.lit(since)) if since else known(df)

    amount, none = F.col("amount_raw"), F.lit(0).cast(RAW)
    taken_out, candidates = later(withdrawals), known(undelegations)
    if since:
        # Of all earlier undelegations only those of the ids withdrawn now can match.
        ids = [*PAIR, "withdraw_id"]
        candidates = candidates.join(taken_out.select(*ids).distinct(), ids, "left_semi")
    settled = matched_withdrawals(taken_out, candidates)
    actions = [
        later(delegations).select(
            *PAIR, "block_timestamp", amount.alias("active"), none.alias("pending")
        ),
        later(undelegations).select(
            *PAIR, "block_timestamp", (-amount).alias("active"), amount.alias("pending")
        ),
        settled.select(
            *PAIR, "block_timestamp", none.alias("active"),
            (-F.col("settled_raw")).alias("pending"),
        ),
    ]
    stacked = actions[0].unionByName(actions[1]).unionByName(actions[2])
    return stacked.groupBy(*PAIR, F.to_date("block_timestamp").alias("balance_date")).agg(
        micro(F.sum("active")).alias("active_raw"),
        micro(F.sum("pending")).alias("pending_raw"),
    )


def ez_staking_balances_daily(
    delegations: DataFrame, undelegations: DataFrame, withdrawals: DataFrame,
    validators: DataFrame | None = None, *, as_of: dt.date,
    previous: DataFrame | None = None, since: dt.date | None = None, keep_raw: bool = False,
) -> DataFrame:
    """Active and pending balance of every pair on every day it is not all zero.

    With ``previous`` (made with ``keep_raw``) and ``since``, only days after ``since``
    are worked out, starting from the exact running sums of that day. ``keep_raw`` adds those sums
    as ``active_raw`` and ``pending_raw`` and keeps days on which a sum, but no published balance, is
    left; ``published`` takes both away again.

    Balances are summed over days with a change and then held until the next one,
    so days without a change cost neither a shuffle nor a window row.
    """
    changes = daily_stake_changes(
        delegations, undelegations, withdrawals, as_of, since
    ).withColumn("is_seed", F.lit(False))
    if previous is not None:
        held = previous.filter(F.col("balance_date") == F.lit(since)).select(
            *PAIR, "balance_date",
            F.col("active_raw").cast(RAW).alias("active_raw"),
            F.col("pending_raw").cast(RAW).alias("pending_raw"),
            F.lit(True).alias("is_seed"),
        )
        changes = changes.unionByName(held)

    # At most one row per pair and day from here on.
    running = (
        Window.partitionBy(*PAIR).orderBy("balance_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    balances = changes.select(
        *PAIR, "balance_date", "is_seed",
        F.sum("active_raw").over(running).cast(RAW).alias("active_sum"),
        F.sum("pending_raw").over(running).cast(RAW).alias("pending_sum"),
        tokens("active_raw").alias("daily_active_change"),
        tokens("pending_raw").alias("daily_pending_change"),
    ).withColumns({
        "active_balance": clamped_tokens(F.col("active_sum")),
        "pending_withdrawal_balance": clamped_tokens(F.col("pending_sum")),
    })
    nothing = (F.col("active_balance") == 0) & (F.col("pending_withdrawal_balance") == 0)
    if keep_raw:
        nothing = (F.col("active_sum") == 0) & (F.col("pending_sum") == 0)
    daily = hold_until_next(
        balances, PAIR, "balance_date", as_of,
        changes=["daily_active_change", "daily_pending_change"], drop_when=nothing,
    ).filter(~(F.col("is_seed") & ~F.col("is_repeated")))
    kept = daily if keep_raw else daily.filter(SHOWN)
    sums = [F.col("active_sum").alias("active_raw"), F.col("pending_sum").alias("pending_raw")] if keep_raw else []
    out = kept.select(
        "balance_date", *PAIR, "active_balance", "pending_withdrawal_balance",
        (F.col("active_balance") + F.col("pending_withdrawal_balance"))
        .alias("total_balance_at_risk"),
        "daily_active_change", "daily_pending_change",
        surrogate_key("balance_date", *PAIR).alias("ez_staking_balances_daily_id"), *sums,
    )
    return enrich(out, validators)


def published(stored: DataFrame) -> DataFrame:
    """The rows and columns of a stored balance table that readers see."""
    return stored.filter(SHOWN).drop("active_raw", "pending_raw", "source_modified_timestamp")


def ez_validator_totals_daily(
    balances: DataFrame, prices: DataFrame, validators: DataFrame | None = None
) -> DataFrame:
    """Delegator balances summed per validator and day, valued at the close.

    Balances hold one row per day and pair, so counting rows counts delegators.
    """
    at_risk = F.col("active_balance") + F.col("pending_withdrawal_balance")
    totals = balances.groupBy("balance_date", "validator_id").agg(
        exact_sum("active_balance").alias("total_active_stake"),
        exact_sum("pending_withdrawal_balance").alias("total_pending_withdrawal"),
        exact_sum(at_risk).alias("total_stake_at_risk"),
        exact_sum("daily_active_change").alias("daily_active_change"),
        exact_sum("daily_pending_change").alias("daily_pending_change"),
        F.count("delegator_address").alias("delegator_count"),
        F.count_if(F.col("active_balance") > 0).alias("active_delegator_count"),
    )
    priced = with_close_price(totals, prices, "balance_date")
    measures = ["total_active_stake", "total_pending_withdrawal", "total_stake_at_risk"]
    valued = [
        c for m in measures for c in (F.col(m), usd(m, "mon_price_usd").alias(f"{m}_usd"))
    ]
    out = priced.select(
        "balance_date", "validator_id", *valued, "daily_active_change", "daily_pending_change",
        "delegator_count", "active_delegator_count", "mon_price_usd",
        surrogate_key("balance_date", "validator_id").alias("ez_validator_totals_daily_id"),
    )
    return enrich(out, validators)


def ez_validator_self_stake(
    balances: DataFrame, created: DataFrame, validators: DataFrame | None = None
) -> DataFrame:
    """Share of a validator's stake that its own address holds, in one grouped pass."""
    owners = created.select("validator_id", F.col("auth_address").alias("validator_address"))
    own = F.lower("delegator_address") == F.lower("validator_address")
    zero = F.lit(0.0)

    def self_sum(c: str):
        return F.coalesce(exact_sum(F.when(own, F.col(c))), zero)

    totals = balances.join(owners, "validator_id").groupBy(
        "balance_date", "validator_id", "validator_address"
    ).agg(
        self_sum("active_balance").alias("self_active_stake"),
        exact_sum("active_balance").alias("total_active_stake"),
        self_sum("pending_withdrawal_balance").alias("self_pending_stake"),
        exact_sum("pending_withdrawal_balance").alias("total_pending_stake"),
        self_sum("total_balance_at_risk").alias("self_stake_at_risk"),
        exact_sum("total_balance_at_risk").alias("total_stake_at_risk"),
    )

    def share(part: str, whole: str):
        pct = F.round(ratio(part, whole) * 100, 4)
        return F.when(F.col(whole) > 0, pct).otherwise(zero)

    out = totals.withColumns({
        "self_stake_pct_of_active": share("self_active_stake", "total_active_stake"),
        "self_stake_pct_of_total": share("self_stake_at_risk", "total_stake_at_risk"),
    })
    return enrich(out, validators)


def ez_validator_balances_daily(
    created: DataFrame, native_balances: DataFrame, prices: DataFrame,
    validators: DataFrame | None = None, *, as_of: dt.date,
    previous: DataFrame | None = None, since: dt.date | None = None,
) -> DataFrame:
    """Wallet balance of every validator address on every day since its first one.

    The input has rows on days of change only; each is held until the next. With
    ``previous`` and ``since``, only days from ``since`` on are returned, carried
    forward from the balance published before it.
    """
    owners = created.select(
        "validator_id", F.lower("auth_address").alias("validator_address")
    ).distinct()
    wallets = native_balances.select(
        F.col("block_date").alias("balance_date"), F.lower("address").alias("validator_address"),
        "balance", F.col("balance_raw").cast(RAW).alias("balance_raw"),
    ).filter((F.col("balance_date") <= F.lit(as_of)) & F.col("balance").isNotNull())
    if since is not None:
        wallets = wallets.filter(F.col("balance_date") >= F.lit(since))
    changes = wallets.join(owners, "validator_address").withColumn("is_seed", F.lit(False))
    if previous is not None:
        held = previous.filter(F.col("balance_date") == F.date_sub(F.lit(since), 1)).select(
            "validator_address", "balance_date", "balance",
            F.col("balance_raw").cast(RAW).alias("balance_raw"), "validator_id",
            F.lit(True).alias("is_seed"),
        )
        changes = changes.unionByName(held)
    daily = hold_until_next(changes, ["validator_id"], "balance_date", as_of).filter(
        ~F.col("is_seed") | F.col("is_repeated")
    )
    priced = with_close_price(daily, prices, "balance_date")
    out = priced.select(
        "balance_date", "validator_id", "validator_address", "balance", "balance_raw",
        "mon_price_usd", usd("balance", "mon_price_usd").alias("balance_usd"),
        F.col("is_repeated").alias("is_forward_filled"),
        surrogate_key("balance_date", "validator_id").alias("ez_validator_balances_daily_id"),
    )
    return enrich(out, validators)
