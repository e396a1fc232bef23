"""State snapshots: request plans, response decoding, priced snapshot facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stakeflow.functions import hexwords as hx
from stakeflow.functions.keccak_address import address_from_key
from stakeflow.functions.keys import surrogate_key
from stakeflow.functions.numeric import RAW, percent, tokens, usd
from stakeflow.operators import daily_last
from stakeflow.sources.tables import STAKING_CONTRACT

# Four-byte selectors of the state calls.
GET_VALIDATOR = "0x2b6d639a"
GET_DELEGATOR = "0x573c1ce0"
GET_VALIDATOR_SET = "0xde66a368"
PAGE_OFFSETS = (0, 100, 200)


def close_prices(prices: DataFrame) -> DataFrame:
    """(price_date, mon_price_usd): last native price of each day."""
    return daily_last(prices.filter("is_native"), "hour", "price", "mon_price_usd")


def with_close_price(df: DataFrame, prices: DataFrame, date_col: str) -> DataFrame:
    closes = close_prices(prices).withColumnRenamed("price_date", date_col)
    return df.join(closes, date_col, "left")


# --- request plans -----------------------------------------------------------


def pending_days(max_blocks: DataFrame) -> DataFrame:
    """(snapshot_date, snapshot_block) from the per-day block table."""
    return max_blocks.groupBy(F.col("block_date").alias("snapshot_date")).agg(
        F.max("block_number").alias("snapshot_block")
    )


def each_with(df: DataFrame, few: DataFrame) -> DataFrame:
    """Every row of ``df`` with each row of ``few``, which holds one row per calendar day.

    The days travel as one array value read by a scalar subquery: a few kilobytes even for years.
    """
    packed = few.agg(F.collect_list(F.struct(*few.columns)))
    return df.withColumn("_few", F.explode(packed.scalar())).select(*df.columns, "_few.*")


def _rpc_body(calldata: Column, block: Column, call_id: Column) -> Column:
    call = F.to_json(F.struct(F.lit(STAKING_CONTRACT).alias("to"), calldata.alias("data")))
    # ``params`` mixes an object and a string, which one array type cannot hold.
    return F.concat(
        F.lit('{"method":"eth_call","jsonrpc":"2.0","params":['), call, F.lit(',"'),
        hx.block_hex(block), F.lit('"],"id":"'), call_id, F.lit('"}'),
    )


def validator_requests(created: DataFrame, days: DataFrame) -> DataFrame:
    """One state call per validator and pending day, for all days given."""
    asked = each_with(created.select("validator_id").distinct(), days)
    calldata = F.concat(F.lit(GET_VALIDATOR), hx.int_word(F.col("validator_id")))
    call_id = F.concat_ws("-", F.lit("getValidator"), "validator_id", "snapshot_date")
    return asked.withColumns({
        "block_hex": hx.block_hex(F.col("snapshot_block")),
        "calldata": calldata,
        "request": _rpc_body(calldata, F.col("snapshot_block"), call_id),
    })


def delegator_requests(created: DataFrame, days: DataFrame) -> DataFrame:
    """One self-delegation call per validator and pending day, for all days given."""
    pairs = created.select("validator_id", "auth_address").distinct()
    asked = each_with(pairs, days)
    calldata = F.concat(
        F.lit(GET_DELEGATOR), hx.int_word(F.col("validator_id")),
        hx.address_word(F.col("auth_address")),
    )
    call_id = F.concat_ws("-", F.lit("getDelegator"), "validator_id", "snapshot_date")
    return asked.withColumns({
        "block_hex": hx.block_hex(F.col("snapshot_block")),
        "calldata": calldata,
        "request": _rpc_body(calldata, F.col("snapshot_block"), call_id),
    })


def set_requests(epochs: DataFrame, offsets: tuple[int, ...] = PAGE_OFFSETS) -> DataFrame:
    """The first wave of paged validator-set calls: every pending epoch with every page offset.

    Sets that go on after the last of these pages are continued by ``next_set_requests``.
    """
    return _set_calls(epochs.select("epoch", "epoch_start_block").withColumn(
        "start_index", F.explode(F.array(*[F.lit(o).cast("bigint") for o in offsets]))
    ))


def set_pages(responses: DataFrame) -> DataFrame:
    """How far each epoch's set has been read: (epoch, epoch_start_block, is_done, next_index).

    A page says whether it is the last one and where the next begins. ``next_index`` is how far pages
    reach without a gap from the start; the set is done when the last page lies within that reach.
    """
    pages = responses.withColumn("words", hx.words(response_payload(F.col("response")))).select(
        "epoch", "epoch_start_block", F.col("start_index").cast("bigint").alias("start"),
        number(1).cast("bigint").alias("next"), (number(0) != 0).alias("last"),
    )
    # A set has few pages, so one array holds them.
    read = pages.groupBy("epoch").agg(
        F.max("epoch_start_block").alias("epoch_start_block"),
        F.array_sort(F.collect_list(F.when(F.col("next").isNotNull(), F.struct("start", "next", "last")))).alias("pages"),
    ).withColumn("next_index", F.aggregate(
        "pages", F.lit(0).cast("bigint"),
        lambda reach, p: F.when(p["start"] <= reach, F.greatest(reach, p["next"])).otherwise(reach),
    ))
    done = F.exists("pages", lambda p: p["last"] & (p["start"] <= F.col("next_index")))
    return read.select("epoch", "epoch_start_block", done.alias("is_done"), "next_index")


def next_set_requests(responses: DataFrame) -> DataFrame:
    """The next page of every set that no response has finished; run until it is empty."""
    return _set_calls(set_pages(responses).filter("NOT is_done").select(
        "epoch", "epoch_start_block", F.col("next_index").alias("start_index")
    ))


def _set_calls(pages: DataFrame) -> DataFrame:
    calldata = F.concat(F.lit(GET_VALIDATOR_SET), hx.int_word(F.col("start_index")))
    call_id = F.concat_ws("-", F.lit("getSnapshotValidatorSet"), "epoch", "start_index")
    return pages.withColumns({
        "block_hex": hx.block_hex(F.col("epoch_start_block")),
        "calldata": calldata,
        "request": _rpc_body(calldata, F.col("epoch_start_block"), call_id),
    })


# --- decoding ----------------------------------------------------------------


def response_payload(response: Column) -> Column:
    """The hex result of a response; NULL when there is none or it is empty."""
    return F.nullif(F.get_json_object(response, "$.data.result"), F.lit("0x"))


def with_words(responses: DataFrame) -> DataFrame:
    """Adds ``payload`` and its 32-byte ``words``; empty responses are dropped."""
    return (
        responses.withColumn("payload", response_payload(F.col("response")))
        .filter(F.col("payload").isNotNull())
        .withColumn("words", hx.words(F.col("payload")))
    )


def number(i: int) -> Column:
    return hx.to_number(hx.word_at(F.col("words"), i))


def snapshot_get_validator(responses: DataFrame) -> DataFrame:
    """Decoded validator state, one row per day and validator."""
    p = with_words(responses)
    raw = p.select(
        "snapshot_date", "validator_id", "snapshot_block", "payload",
        hx.to_address(hx.word_at(F.col("words"), 0)).alias("auth_address"),
        number(1).alias("flags"),
        number(2).alias("execution_stake_raw"),
        number(3).alias("accumulated_rewards_per_token_raw"),
        number(4).alias("execution_commission_bps"),
        number(5).alias("unclaimed_rewards_raw"),
        number(6).alias("consensus_stake_raw"),
        number(7).alias("consensus_commission_bps"),
        number(8).alias("snapshot_stake_raw"),
        number(9).alias("snapshot_commission_bps"),
        number(10).alias("_secp_at"),
        number(11).alias("_bls_at"),
    )
    return raw.select(
        "snapshot_date", "validator_id", "snapshot_block", "auth_address", "flags",
        "execution_stake_raw", tokens("execution_stake_raw").alias("execution_stake"),
        "accumulated_rewards_per_token_raw",
        "execution_commission_bps",
        percent("execution_commission_bps").alias("execution_commission_pct"),
        "unclaimed_rewards_raw", tokens("unclaimed_rewards_raw").alias("unclaimed_rewards"),
        "consensus_stake_raw", tokens("consensus_stake_raw").alias("consensus_stake"),
        "consensus_commission_bps",
        percent("consensus_commission_bps").alias("consensus_commission_pct"),
        "snapshot_stake_raw", tokens("snapshot_stake_raw").alias("snapshot_stake"),
        "snapshot_commission_bps",
        percent("snapshot_commission_bps").alias("snapshot_commission_pct"),
        hx.dynamic_bytes(F.col("payload"), F.col("_secp_at")).alias("secp_pubkey"),
        hx.dynamic_bytes(F.col("payload"), F.col("_bls_at")).alias("bls_pubkey"),
        surrogate_key("snapshot_date", "validator_id").alias("snapshot_get_validator_id"),
    )


def snapshot_validator_set(responses: DataFrame) -> DataFrame:
    """Validator set members, one row per epoch and validator.

    Pages without a result or without members yield no array elements.
    """
    pages = responses.withColumn(
        "words", hx.words(response_payload(F.col("response")))
    ).withColumn("array_length", number(3).try_cast("int"))
    members = pages.select(
        "epoch", "epoch_start_block", "start_index",
        F.posexplode(F.slice("words", F.lit(5), F.col("array_length"))).alias("_at", "_word"),
    )
    return members.select(
        "epoch", "epoch_start_block",
        hx.to_number(F.col("_word")).cast("bigint").alias("validator_id"),
        (F.col("start_index") + F.col("_at")).alias("validator_position"),
    ).filter(F.col("validator_id").isNotNull()).withColumn(
        "snapshot_validator_set_id", surrogate_key("epoch", "validator_id")
    )


def validator_addresses(created: DataFrame, decoded: DataFrame) -> DataFrame:
    """Consensus address of every validator, from its latest known public key."""
    # The NULL test sits in the aggregate: as a filter it would repeat the decoding.
    known_on = F.when(F.col("secp_pubkey").isNotNull(), F.col("snapshot_date"))
    latest = decoded.groupBy("validator_id").agg(
        F.max_by("secp_pubkey", known_on).alias("secp_pubkey"),
        F.max(known_on).alias("address_snapshot_date"),
    )
    # A key's address is worked out once, however many validators present it.
    derived = (
        latest.select("secp_pubkey").distinct()
        .withColumn("consensus_address", address_from_key(F.col("secp_pubkey")))
    )
    known = latest.join(derived, "secp_pubkey").filter(F.col("consensus_address").isNotNull())
    return created.select(
        "validator_id", "auth_address", F.col("block_timestamp").alias("validator_created_at")
    ).join(known, "validator_id", "left").select(
        "validator_id", "auth_address", "consensus_address", "secp_pubkey",
        "address_snapshot_date", "validator_created_at",
        surrogate_key("validator_id").alias("validator_addresses_id"),
    )


# --- priced facts ------------------------------------------------------------


def fact_validator_snapshots(decoded: DataFrame, prices: DataFrame) -> DataFrame:
    """Decoded validator state valued at the day's closing price."""
    priced = with_close_price(decoded, prices, "snapshot_date")
    p = F.col("mon_price_usd")
    return priced.select(
        "snapshot_date", "validator_id", "snapshot_block", "auth_address", "flags",
        "execution_stake_raw", "execution_stake",
        usd("execution_stake", p).alias("execution_stake_usd"),
        "accumulated_rewards_per_token_raw", "execution_commission_bps",
        "execution_commission_pct", "unclaimed_rewards_raw", "unclaimed_rewards",
        usd("unclaimed_rewards", p).alias("unclaimed_rewards_usd"),
        "consensus_stake_raw", "consensus_stake",
        usd("consensus_stake", p).alias("consensus_stake_usd"),
        "consensus_commission_bps", "consensus_commission_pct",
        "snapshot_stake_raw", "snapshot_stake",
        usd("snapshot_stake", p).alias("snapshot_stake_usd"),
        "snapshot_commission_bps", "snapshot_commission_pct",
        "secp_pubkey", "bls_pubkey", "mon_price_usd",
        surrogate_key("snapshot_date", "validator_id").alias("fact_validator_snapshots_id"),
    )


def fact_validator_self_delegation_snapshots(
    responses: DataFrame, prices: DataFrame
) -> DataFrame:
    """A validator's own delegation and unclaimed earnings, one row per day."""
    parsed = with_words(responses).select(
        "snapshot_date", "validator_id", "auth_address", "snapshot_block",
        number(0).alias("stake_raw"),
        number(1).alias("acc_reward_per_token_raw"),
        number(2).alias("unclaimed_rewards_raw"),
        number(3).alias("delta_stake_raw"),
        number(4).alias("next_delta_stake_raw"),
        number(5).alias("delta_epoch"),
        number(6).alias("next_delta_epoch"),
    )
    priced = with_close_price(parsed, prices, "snapshot_date").withColumns({
        "stake": tokens("stake_raw"),
        "unclaimed_rewards": tokens("unclaimed_rewards_raw"),
    })
    pending = (F.col("delta_stake_raw") + F.col("next_delta_stake_raw")).cast(RAW)
    return priced.select(
        "snapshot_date", "validator_id", "auth_address", "snapshot_block",
        "stake_raw", "stake", usd("stake", "mon_price_usd").alias("stake_usd"),
        "acc_reward_per_token_raw",
        "unclaimed_rewards_raw", "unclaimed_rewards",
        usd("unclaimed_rewards", "mon_price_usd").alias("unclaimed_rewards_usd"),
        "delta_stake_raw", tokens("delta_stake_raw").alias("delta_stake"),
        "next_delta_stake_raw", tokens("next_delta_stake_raw").alias("next_delta_stake"),
        "delta_epoch", "next_delta_epoch",
        tokens(pending).alias("total_pending_stake"),
        "mon_price_usd",
        surrogate_key("snapshot_date", "validator_id").alias(
            "fact_validator_self_delegation_snapshots_id"
        ),
    )
