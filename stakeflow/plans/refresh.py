"""Incremental refresh of the stored tables.

Every function reads what its target already holds, works out the part to load,
and rewrites only the partitions concerned. Running one twice changes nothing.

The watermark is the newest *source* timestamp a target has taken in, kept as
``source_modified_timestamp``: the load clock would skip rows that the source
stamped before, but published after, the previous load.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakeflow.operators import latest_per_key
from stakeflow.plans import balances, blocks, snapshots
from stakeflow.plans.events import CONTEXT, FACTS, ORIGIN, fact
from stakeflow.sources.increments import (
    BEGINNING, high_watermark, missing_periods, since_watermark, window_start,
)
from stakeflow.session import shared_dir
from stakeflow.sources.sinks import read_target, remove, replace_partitions, swap_in, upsert_replace
from stakeflow.sources.tables import staking_events

MARK = "source_modified_timestamp"
REWARD_MARK = "reward_source_timestamp"
FACTS_AT_ONCE = 4  # facts whose jobs run side by side


def refresh_event_fact(spark: SparkSession, logs: DataFrame, path: str, name: str) -> None:
    """One event fact: rows newer than the watermark, upserted by key, one folder per day."""
    fresh = since_watermark(with_mark(logs), read_target(spark, path), MARK)
    store_event_fact(spark, fact(fresh, name, keep=[MARK]), path, name)


def refresh_event_facts(spark: SparkSession, logs: DataFrame, paths: dict[str, str]) -> None:
    """Several event facts from one scan of the logs.

    The logs newer than the oldest watermark of the targets are read once. Each event keeps its own target's
    watermark in that scan, so an event that is rare, and therefore has an old one, does not make the others load
    again what they hold. The rows are staged on shared storage in one folder per event; each fact then reads only
    its own folder.
    """
    marks = {name: high_watermark(read_target(spark, path), MARK, BEGINNING) for name, path in paths.items()}
    own = F.create_map(*[F.lit(x) for name, mark in marks.items() for x in (FACTS[name][0], mark.isoformat(sep=" "))])
    fresh = _after(with_mark(logs), MARK, min(marks.values())).filter(
        F.col(MARK) > F.element_at(own, F.col("event_name")).cast("timestamp_ntz")
    )
    fan_out_facts(spark, fresh, paths)


def fan_out_facts(spark: SparkSession, rows: DataFrame, paths: dict[str, str]) -> None:
    """Stage ``rows`` (logs with ``MARK``) once by event, then store each fact from its own folder.

    A few facts are stored at a time, so that the last tasks of one leave no cores idle.
    """
    staged = shared_dir(spark, "event-batch")
    wanted = [FACTS[name][0] for name in paths]
    staking_events(rows).filter(F.col("event_name").isin(wanted)).select(
        *CONTEXT, *ORIGIN, "decoded_log", "tx_succeeded", MARK
    ).write.partitionBy("event_name").parquet(staged)
    try:
        stored = spark.read.parquet(staged)

        def store(name: str) -> None:
            own = stored.filter(F.col("event_name") == FACTS[name][0])
            store_event_fact(spark, fact(own, name, keep=[MARK]), paths[name], name)

        with ThreadPoolExecutor(FACTS_AT_ONCE) as pool:
            list(pool.map(store, paths))
    finally:
        remove(spark, staged)


def with_mark(logs: DataFrame) -> DataFrame:
    return logs.withColumn(MARK, F.col("modified_timestamp"))


def store_event_fact(spark: SparkSession, rows: DataFrame, path: str, name: str) -> None:
    """The one writer of event facts, for batches and streams: the latest version of each key is upserted.

    An event that has moved to another day leaves its old one.
    """
    key = FACTS[name][1]
    batch = latest_per_key(rows, [key], MARK).withColumn("block_date", F.to_date("block_timestamp"))
    upsert_replace(spark, path, batch, key, "block_date", ["block_number"])


def refresh_block_fees(
    spark: SparkSession, transactions: DataFrame, chain_blocks: DataFrame, rewards: DataFrame,
    path: str,
) -> None:
    """Priority fees: blocks with new transactions or new producer rewards are recomputed as a whole.

    Rewards are noticed by the mark column of a stored reward fact; each source has a mark of its own.
    """
    target = read_target(spark, path)
    mark = high_watermark(target, MARK, BEGINNING)
    by_reward = MARK in rewards.columns
    reward_mark = BEGINNING
    if target is not None and REWARD_MARK in target.columns:
        reward_mark = high_watermark(target, REWARD_MARK, BEGINNING)
    newest = high_watermark(_after(transactions, "modified_timestamp", mark), "modified_timestamp", mark)
    newest_reward = high_watermark(_after(rewards, MARK, reward_mark), MARK, reward_mark) if by_reward else reward_mark
    if newest <= mark and newest_reward <= reward_mark:
        return
    fees = (
        blocks.fact_block_priority_fees(transactions, chain_blocks, rewards)
        if target is None
        else blocks.fact_block_priority_fees_increment(
            transactions, chain_blocks, rewards, mark,
            _after(rewards, MARK, reward_mark) if by_reward else None,
        )
    )
    stamps = {MARK: newest} | ({REWARD_MARK: newest_reward} if by_reward else {})
    batch = fees.withColumns({
        "block_date": F.to_date("block_timestamp"),
        **{name: F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz") for name, at in stamps.items()},
    })
    upsert_replace(
        spark, path, batch, "fact_block_priority_fees_id", "block_date", ["block_number"]
    )


def _after(df: DataFrame, col: str, mark: dt.datetime) -> DataFrame:
    return df.filter(F.col(col) > F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz"))


def refresh_snapshots(
    spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str] = ("snapshot_date", "validator_id"),
) -> None:
    """Snapshot facts, upserted by key.

    Rows with a mark column are taken when the source stamped them after the last load, however
    old their day is. Without one, rows whose key the target does not hold are taken.
    """
    target = read_target(spark, path)
    if MARK in rows.columns:
        batch = latest_per_key(since_watermark(rows, target, MARK), list(keys), MARK)
    elif target is not None:
        batch = rows.join(target.select(*keys), list(keys), "left_anti")
    else:
        batch = rows
    upsert_replace(spark, path, batch, list(keys), "snapshot_date", ["validator_id"], moves=False)


def refresh_decoded(
    spark: SparkSession, responses: DataFrame, path: str, decode: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
) -> None:
    """A table of decoded responses, one folder per value of the first key.

    Responses whose key has decoded rows already are skipped before they are decoded; those of keys that
    came back empty, and whatever arrives late, are decoded now.
    """
    target = read_target(spark, path)
    given = [k for k in keys if k in responses.columns]
    fresh = responses if target is None else responses.join(target.select(*given).distinct(), given, "left_anti")
    upsert_replace(spark, path, decode(fresh), list(keys), keys[0], [keys[-1]], moves=False)


def refresh_validator_states(spark: SparkSession, responses: DataFrame, path: str) -> None:
    """Decoded validator state per day and validator."""
    refresh_decoded(spark, responses, path, snapshots.snapshot_get_validator, ("snapshot_date", "validator_id"))


def refresh_delegator_states(
    spark: SparkSession, responses: DataFrame, prices: DataFrame, path: str
) -> None:
    """Decoded self-delegation per day and validator."""
    refresh_decoded(
        spark, responses, path,
        lambda fresh: snapshots.fact_validator_self_delegation_snapshots(fresh, prices),
        ("snapshot_date", "validator_id"),
    )


def refresh_validator_set(spark: SparkSession, responses: DataFrame, path: str) -> None:
    """Set members per epoch. An epoch is decoded when its last page is there, so no set is stored in part."""
    target = read_target(spark, path)
    whole = snapshots.set_pages(responses).filter("is_done").select("epoch")
    if target is not None:
        whole = whole.join(target.select("epoch").distinct(), "epoch", "left_anti")
    fresh = snapshots.snapshot_validator_set(responses.join(whole, "epoch", "left_semi"))
    upsert_replace(spark, path, fresh, ["epoch", "validator_id"], "epoch", ["validator_id"], moves=False)


def refresh_validator_addresses(spark: SparkSession, created: DataFrame, states: DataFrame, path: str) -> None:
    """The address table, one row per validator, replaced as a whole."""
    swap_in(snapshots.validator_addresses(created, states), path, ["validator_id"])


def pending_state_requests(
    spark: SparkSession, created: DataFrame, max_blocks: DataFrame, path: str, *, as_of: dt.date, back: int = 7,
) -> DataFrame:
    """Validator state calls for every (validator, day) of the last ``back`` days that the stored table has no answer for.

    The stored table of decoded states is the ledger of answered calls (empty answers are never stored), so the anti
    join is at the grain of a call: a validator whose call failed is asked again on the next run, while the validators
    answered on the same day are not asked twice.
    """
    return _unanswered(
        snapshots.validator_requests(created, _recent_days(max_blocks, as_of, back)), read_target(spark, path)
    )


def pending_delegator_requests(
    spark: SparkSession, created: DataFrame, max_blocks: DataFrame, path: str, *, as_of: dt.date, back: int = 7,
) -> DataFrame:
    """Self-delegation calls for every (validator, day) of the last ``back`` days without a stored answer."""
    return _unanswered(
        snapshots.delegator_requests(created, _recent_days(max_blocks, as_of, back)), read_target(spark, path)
    )


def _recent_days(max_blocks: DataFrame, as_of: dt.date, back: int) -> DataFrame:
    start = as_of - dt.timedelta(days=back)
    day = F.col("block_date")
    return snapshots.pending_days(max_blocks.filter((day >= F.lit(start)) & (day < F.lit(as_of))))


def _unanswered(requests: DataFrame, answered: DataFrame | None) -> DataFrame:
    """Requests whose (validator, day) has no stored answer; the answers are read for the days asked only."""
    if answered is None:
        return requests
    keys = ["validator_id", "snapshot_date"]
    low, high = F.lit(BEGINNING.date()), F.lit(dt.date(9999, 12, 31))
    bounds = requests.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    if bounds[0] is not None:
        low, high = F.lit(bounds[0]), F.lit(bounds[1])
    held = answered.filter(F.col("snapshot_date").between(low, high)).select(*keys).distinct()
    return requests.join(held, keys, "left_anti")


def refresh_miner_ranges(
    spark: SparkSession, rewards: DataFrame, chain_blocks: DataFrame, path: str
) -> None:
    """Miner ranges: extend open ranges, rebuild validators with late rewards.

    ``rewards`` carries the mark column of a stored fact.
    """
    target = read_target(spark, path)
    newest = high_watermark(rewards, MARK, BEGINNING)
    stamp = F.lit(newest.isoformat(sep=" ")).cast("timestamp_ntz")
    if target is None:
        ranges = blocks.dim_miner_validators(rewards, chain_blocks)
    else:
        fresh = since_watermark(rewards, target, MARK)
        ranges = blocks.dim_miner_validators_increment(
            target.drop(MARK), fresh, rewards, chain_blocks
        )
    swap_in(ranges.withColumn(MARK, stamp), path, ["validator_id", "start_block"])


def _days(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def refresh_stake_balances(
    spark: SparkSession, delegations: DataFrame, undelegations: DataFrame,
    withdrawals: DataFrame, path: str, *, as_of: dt.date, days: int = 3,
) -> None:
    """Stake balances: the last ``days`` stored days and everything after them, and pairs with late events.

    The table keeps the exact running sums; ``balances.published`` is what readers see. Where the facts carry
    ``MARK`` (stored facts do), the table keeps the newest mark it has taken in. A fact stamped after that mark but
    dated on or before the window is late: every (validator, delegator) pair with one is recomputed from the stored
    sums of the day before the earliest late day, and other pairs keep their stored rows there. So a refresh equals a
    rebuild however old a late event is, and the work is the late pairs' rows, not the whole history.
    """
    facts = (delegations, undelegations, withdrawals)
    marked = all(MARK in f.columns for f in facts)
    newest = max(high_watermark(f, MARK, BEGINNING) for f in facts) if marked else None
    target = read_target(spark, path)
    since = window_start(target, "balance_date", days) if target is not None else None
    batch = balances.ez_staking_balances_daily(
        *facts, as_of=as_of, since=since, previous=target if since else None, keep_raw=True,
    )
    start = since
    staged = None
    try:
        if since is not None and marked and MARK in target.columns:
            # Six joins below need the late pairs; they are worked out once.
            staged = shared_dir(spark, "late-pairs")
            late_pairs(facts, high_watermark(target, MARK, BEGINNING), since).write.parquet(staged)
            late = spark.read.parquet(staged)
            first = late.agg(F.min("first_day")).first()[0]
            if first is not None:
                start = first - dt.timedelta(days=1)
                pairs = late.select(*balances.PAIR)
                redone = balances.ez_staking_balances_daily(
                    *(f.join(pairs, balances.PAIR, "left_semi") for f in facts), as_of=as_of, since=start,
                    previous=target.join(pairs, balances.PAIR, "left_semi"), keep_raw=True,
                )
                unchanged = target.filter(
                    (F.col("balance_date") > F.lit(start)) & (F.col("balance_date") <= F.lit(since))
                ).join(pairs, balances.PAIR, "left_anti").drop(MARK)
                batch = batch.join(pairs, balances.PAIR, "left_anti").unionByName(redone).unionByName(
                    unchanged, allowMissingColumns=True
                )
        if newest is not None:
            batch = batch.withColumn(MARK, F.lit(newest.isoformat(sep=" ")).cast("timestamp_ntz"))
        covered = _days(start + dt.timedelta(days=1), as_of) if start else ()
        replace_partitions(spark, path, batch, "balance_date", ["validator_id"], covered=covered)
    finally:
        if staged is not None:
            remove(spark, staged)


def late_pairs(facts: Sequence[DataFrame], mark: dt.datetime, since: dt.date) -> DataFrame:
    """(validator_id, delegator_address, first_day): pairs with facts stamped after ``mark`` but dated on or before ``since``.

    One row per pair, aggregated on the map side, so a burst of late rows for one pair is one row.
    """
    stamp = F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
    day = F.to_date("block_timestamp")
    rows = [f.filter((F.col(MARK) > stamp) & (day <= F.lit(since))).select(*balances.PAIR, day.alias("day")) for f in facts]
    stacked = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return stacked.groupBy(*balances.PAIR).agg(F.min("day").alias("first_day"))


def refresh_wallet_balances(
    spark: SparkSession, created: DataFrame, native_balances: DataFrame, prices: DataFrame,
    path: str, *, as_of: dt.date, days: int = 7,
) -> None:
    """Wallet balances: the last ``days`` published days and everything after them."""
    target = read_target(spark, path)
    since = window_start(target, "balance_date", days) if target is not None else None
    batch = balances.ez_validator_balances_daily(
        created, native_balances, prices, as_of=as_of, since=since,
        previous=target if since else None,
    )
    covered = _days(since, as_of) if since else ()
    replace_partitions(spark, path, batch, "balance_date", ["validator_id"], covered=covered)


def refresh_epoch_performance(
    spark: SparkSession, validator_set: DataFrame, created: DataFrame, epochs: DataFrame,
    states: DataFrame, production: DataFrame, path: str, *, back: int = 5,
) -> None:
    """Epoch performance: the last ``back`` published epochs and everything after them."""
    target = read_target(spark, path)
    since = window_start(target, "epoch", back) if target is not None else None
    covered: Sequence[int] = ()
    if since is not None:
        covered = range(since + 1, since + back + 1)
        recent = F.col("epoch") > F.lit(since)
        validator_set, production = validator_set.filter(recent), production.filter(recent)
    batch = blocks.ez_validator_epoch_performance(
        validator_set, created, epochs, states, production
    )
    replace_partitions(spark, path, batch, "epoch", ["validator_id"], covered=covered)


def refresh_validators(spark: SparkSession, validators: DataFrame, path: str) -> None:
    """The validator dimension, replaced as a whole."""
    swap_in(validators, path, ["validator_id"])
