"""Pipeline edge rows, worked out by hand."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stakeflow.plans import balances, blocks, decisions, earnings, events, snapshots, validators
from stakeflow.sources.tables import REWARD_SELECTOR, STAKING_CONTRACT
from tests.conftest import day, rows, same, ts, wei

AS_OF = dt.date(2024, 1, 6)
STAKE = (
    "validator_id bigint, delegator_address string, withdraw_id bigint, "
    "block_timestamp timestamp_ntz, block_number bigint, event_index int, amount_raw decimal(38,0)"
)


def stakes(spark, *items):
    """(validator, delegator, withdraw id, time, amount)"""
    data = [(v, d, w, ts(t), i, 0, wei(a)) for i, (v, d, w, t, a) in enumerate(items)]
    return spark.createDataFrame(data, STAKE)


def log(spark, *items):
    """(event name, contract, succeeded, body)"""
    data = [
        (i, ts("01T00:00:00"), f"0x{i}", 0, contract, name, json.dumps(body), "o", STAKING_CONTRACT,
         REWARD_SELECTOR, ok)
        for i, (name, contract, ok, body) in enumerate(items)
    ]
    return spark.createDataFrame(
        data, "block_number bigint, block_timestamp timestamp_ntz, tx_hash string, event_index int, "
        "contract_address string, event_name string, decoded_log string, origin_from_address string, "
        "origin_to_address string, origin_function_signature string, tx_succeeded boolean"
    )


def test_extraction_filters_and_reads_wide_integers(spark):
    wide = 10**37 + 1
    body = {"validatorId": 3, "delegator": "0xd1", "amount": str(wide), "activationEpoch": 9}
    logs = log(
        spark, ("Delegate", STAKING_CONTRACT, True, body), ("Delegate", STAKING_CONTRACT, False, body),
        ("Delegate", "0xother", True, body), ("Undelegate", STAKING_CONTRACT, True, body),
    )
    found = rows(events.fact_delegations(logs))
    assert len(found) == 1
    assert found[0]["amount_raw"] == Decimal(wide) and found[0]["validator_id"] == 3
    assert found[0]["amount"] == wide / 1e18


def test_extraction_is_strict(spark):
    logs = log(spark, ("Delegate", STAKING_CONTRACT, True, {"validatorId": "three"}))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST"):
        events.fact_delegations(logs).collect()


def test_withdrawal_takes_latest_earlier_undelegation(spark):
    undelegated = stakes(
        spark, (1, "d", 0, "01T10:00:00", "5"), (1, "d", 0, "03T10:00:00", "7"),
        (1, "d", 1, "02T00:00:00", "9"),
    )
    withdrawn = stakes(
        spark, (1, "d", 0, "02T10:00:00", "5.1"), (1, "d", 0, "04T10:00:00", "7.2"),
        (1, "d", 1, "02T00:00:00", "9.3"),  # same instant: not before it
        (1, "e", 0, "02T00:00:00", "4"),  # no undelegation at all
    )
    settled = rows(balances.matched_withdrawals(withdrawn, undelegated), "amount_raw")
    assert {r["amount_raw"]: r["settled_raw"] for r in settled} == {
        wei("5.1"): wei("5"), wei("7.2"): wei("7"), wei("9.3"): wei("9.3"), wei("4"): wei("4"),
    }


def test_balances_clamp_but_keep_changes(spark):
    none = stakes(spark, (9, "z", 0, "01T00:00:00", "1")).limit(0)
    delegated = stakes(spark, (1, "d", 0, "02T00:00:00", "0.00006"))
    undelegated = stakes(spark, (1, "d", 0, "03T00:00:00", "0.00001"))
    out = rows(balances.ez_staking_balances_daily(delegated, undelegated, none, as_of=AS_OF))
    assert [(r["balance_date"].day, r["active_balance"], r["daily_active_change"]) for r in out] == [
        (2, 0.0, 0.00006), (3, 0.0, -0.00001)
    ]


def test_balances_repeat_until_closed(spark):
    delegated = stakes(spark, (1, "d", 0, "01T00:00:00", "5"))
    undelegated = stakes(spark, (1, "d", 0, "03T00:00:00", "5"))
    withdrawn = stakes(spark, (1, "d", 0, "05T00:00:00", "6"))
    out = rows(
        balances.ez_staking_balances_daily(delegated, undelegated, withdrawn, as_of=AS_OF), "balance_date"
    )
    assert [
        (r["balance_date"].day, r["active_balance"], r["pending_withdrawal_balance"],
         r["total_balance_at_risk"], r["daily_pending_change"]) for r in out
    ] == [
        (1, 5.0, 0.0, 5.0, 0.0), (2, 5.0, 0.0, 5.0, 0.0), (3, 0.0, 5.0, 5.0, 5.0),
        (4, 0.0, 5.0, 5.0, 0.0), (5, 0.0, 0.0, 0.0, -5.0),
    ]
    key = [r["ez_staking_balances_daily_id"] for r in out]
    assert len(set(key)) == len(key)


def test_self_stake_share(spark):
    held = spark.createDataFrame(
        [(day(1), 1, "0xAA", 3.0, 0.0, 3.0), (day(1), 1, "0xbb", 1.0, 0.0, 1.0), (day(2), 2, "0xcc", 0.0, 0.0, 0.0)],
        "balance_date date, validator_id bigint, delegator_address string, active_balance double, "
        "pending_withdrawal_balance double, total_balance_at_risk double",
    )
    created = spark.createDataFrame([(1, "0xaa"), (2, "0xdd")], "validator_id bigint, auth_address string")
    out = rows(balances.ez_validator_self_stake(held, created), "validator_id")
    assert [(r["self_active_stake"], r["self_stake_pct_of_active"]) for r in out] == [(3.0, 75.0), (0.0, 0.0)]


def prices(spark, *items):
    return spark.createDataFrame(
        [(ts(t), p, native) for t, p, native in items], "hour timestamp_ntz, price double, is_native boolean"
    )


def test_wallet_balance_fills_across_window_start(spark):
    created = spark.createDataFrame([(1, "0xAA")], "validator_id bigint, auth_address string")
    native = spark.createDataFrame(
        [(day(1), "0xaa", 4.0, wei("4")), (day(5), "0xAA", 6.0, wei("6"))],
        "block_date date, address string, balance double, balance_raw decimal(38,0)",
    )
    quotes = prices(spark, ("03T01:00:00", 9.0, True), ("03T02:00:00", 2.0, True), ("03T03:00:00", 8.0, False))
    full = balances.ez_validator_balances_daily(created, native, quotes, as_of=AS_OF)
    out = rows(full, "balance_date")
    assert [(r["balance_date"].day, r["balance"], r["is_forward_filled"]) for r in out] == [
        (1, 4.0, False), (2, 4.0, True), (3, 4.0, True), (4, 4.0, True), (5, 6.0, False), (6, 6.0, True)
    ]
    assert out[2]["balance_usd"] == 8.0 and out[0]["balance_usd"] is None
    later = balances.ez_validator_balances_daily(
        created, native, quotes, as_of=AS_OF, previous=full, since=day(3)
    )
    same(later, full.filter(F.col("balance_date") >= F.lit(day(3))))


def rewards(spark, *items):
    """(block, validator)"""
    data = [
        (n, ts("01T00:00:00") + dt.timedelta(seconds=n), v, 1, wei("1"), STAKING_CONTRACT, REWARD_SELECTOR)
        for n, v in items
    ]
    return spark.createDataFrame(
        data, "block_number bigint, block_timestamp timestamp_ntz, validator_id bigint, epoch bigint, "
        "amount_raw decimal(38,0), origin_to_address string, origin_function_signature string"
    )


def chain_blocks(spark, miners):
    return spark.createDataFrame(
        [(n, m, Decimal(10**9)) for n, m in miners.items()],
        "block_number bigint, miner string, base_fee_per_gas decimal(38,0)",
    )


MINED = {1: "a", 2: "a", 3: "b", 4: "b", 5: "a", 6: "c", 7: "c"}


@pytest.mark.parametrize("first", [[1, 2], [1, 2, 3], [1, 2, 3, 4, 5], [2, 3, 5], []])
def test_miner_ranges_increment_equals_rebuild(spark, first):
    """Covers a change on the first new block, a new validator, and late rewards."""
    whole = rewards(spark, *[(n, 1) for n in MINED], (8, 2), (9, 2))
    mined = chain_blocks(spark, {**MINED, 8: "a", 9: "a"})
    full = blocks.dim_miner_validators(whole, mined)
    old = F.col("block_number").isin(first)
    current = blocks.dim_miner_validators(whole.filter(old), mined)
    same(blocks.dim_miner_validators_increment(current, whole.filter(~old), whole, mined), full)
    out = rows(full.filter("validator_id = 1"), "start_block")
    assert [(r["miner"], r["start_block"], r["end_block"], r["next_miner"], r["is_current"]) for r in out] == [
        ("a", 1, 2, "b", False), ("b", 3, 4, "a", False), ("a", 5, 5, "c", False), ("c", 6, 7, None, True)
    ]
    assert rows(full.filter("validator_id = 2"))[0]["blocks_produced"] == 2


def transactions(spark, *items):
    """(block, gas, gwei, modified)"""
    return spark.createDataFrame(
        [(n, ts("01T00:00:00"), f"0x{i}", g, p, ts(m)) for i, (n, g, p, m) in enumerate(items)],
        "block_number bigint, block_timestamp timestamp_ntz, tx_hash string, gas_used bigint, "
        "effective_gas_price double, modified_timestamp timestamp_ntz",
    )


def test_fees_and_late_transaction(spark):
    mined = chain_blocks(spark, {1: "a", 2: "b"})
    produced = rewards(spark, (1, 7))
    txs = transactions(
        spark, (1, 100, 3.5, "01T00:00:00"), (1, 10, 1.0, "01T00:00:00"), (2, 1, 2.0, "01T00:00:00"),
        (1, 1000, 0.5, "05T00:00:00"),
    )
    full = blocks.fact_block_priority_fees(txs, mined, produced)
    first = rows(full, "block_number")[0]
    assert first["tx_count"] == 3 and first["tx_count_with_priority_fee"] == 1
    assert first["total_priority_fee"] == (2.5 * 100 - 0.5 * 1000) / 1e9
    assert first["validator_id"] == 7 and first["base_fee_per_gas"] == 1.0
    assert first["min_priority_fee_per_gas"] == -0.5 / 1e9
    assert rows(full, "block_number")[1]["validator_id"] is None
    again = blocks.fact_block_priority_fees_increment(txs, mined, produced, ts("03T00:00:00"))
    same(again, full.filter("block_number = 1"))


def test_fees_wider_than_64_bits(spark):
    mined = chain_blocks(spark, {1: "a"})
    txs = transactions(spark, (1, 3 * 10**9, 10.0**9, "01T00:00:00"))
    out = rows(blocks.fact_block_priority_fees(txs, mined, rewards(spark, (1, 7))))[0]
    assert out["total_priority_fee"] == pytest.approx(3e9 * (1e9 - 1) / 1e9, rel=1e-12)


def test_open_epoch(spark):
    changes = spark.createDataFrame(
        [(1, 10, ts("01T00:00:00"), "x"), (3, 30, ts("01T01:00:00"), "y")],
        "new_epoch bigint, block_number bigint, block_timestamp timestamp_ntz, tx_hash string",
    )
    out = rows(blocks.dim_epochs(changes, chain_blocks(spark, {50: "a"})), "epoch")
    assert [(r["epoch"], r["epoch_end_block"], r["epoch_block_count"], r["epoch_duration_seconds"]) for r in out] == [
        (1, 29, 20, 3600), (3, 50, 21, None)
    ]


def performance_inputs(spark, stake):
    members = spark.createDataFrame([(5, 1, 0), (5, 2, 1)], "epoch bigint, validator_id bigint, validator_position bigint")
    created = spark.createDataFrame(
        [(1, "0xa", ts("01T00:00:00")), (2, "0xb", ts("01T00:00:00"))],
        "validator_id bigint, auth_address string, block_timestamp timestamp_ntz",
    )
    epochs = spark.createDataFrame(
        [(5, 100, ts("03T00:00:00"), ts("03T05:00:00"))],
        "epoch bigint, epoch_block_count bigint, epoch_start_timestamp timestamp_ntz, epoch_end_timestamp timestamp_ntz",
    )
    states = spark.createDataFrame(stake, "validator_id bigint, snapshot_date date, snapshot_stake double")
    made = spark.createDataFrame(
        [(5, 1, 60, 6.0, 0.1)],
        "epoch bigint, validator_id bigint, blocks_produced bigint, total_block_rewards double, avg_reward_per_block double",
    )
    return members, created, epochs, states, made


def test_stake_prefers_previous_day_then_same_day(spark):
    out = rows(blocks.ez_validator_epoch_performance(*performance_inputs(
        spark, [(1, day(2), 30.0), (1, day(3), 99.0), (2, day(3), 10.0)]
    )), "validator_id")
    assert [r["validator_stake"] for r in out] == [30.0, 10.0]
    assert [r["expected_blocks_per_validator"] for r in out] == [75.0, 25.0]
    assert [r["blocks_vs_expected"] for r in out] == [-15.0, -25.0]
    assert [r["production_rank"] for r in out] == [1, 2]
    assert sum(r["expected_pct_of_epoch_blocks"] for r in out) == 100.0


def test_zero_stake_epoch_and_missing_expectation(spark):
    inputs = performance_inputs(spark, [(1, day(9), 30.0)])
    performance = blocks.ez_validator_epoch_performance(*inputs)
    assert [r["stake_weight"] for r in rows(performance)] == [None, None]
    earned = spark.createDataFrame([(1, day(2), 4.0)], "validator_id bigint, earning_date date, total_earned double")
    out = rows(blocks.ez_miss_rate(performance, earned, prices(spark, ("01T00:00:00", 2.0, True))), "validator_id")
    assert [(r["missed_blocks"], r["miss_rate_pct"], r["uptime_pct"]) for r in out] == [(None, 0.0, 100.0)] * 2
    assert out[0]["mon_price_usd"] == 2.0
    none = rows(blocks.ez_miss_rate(performance, earned, prices(spark, ("01T00:00:00", 2.0, False))))
    assert none[0]["mon_price_usd"] == 0.0


def self_snapshots(spark, *items):
    """(validator, day, unclaimed, price)"""
    return spark.createDataFrame(
        [(v, day(d), 1.0, u, u * p, p) for v, d, u, p in items],
        "validator_id bigint, snapshot_date date, stake double, unclaimed_rewards double, "
        "unclaimed_rewards_usd double, mon_price_usd double",
    )


def claim_rows(spark, *items):
    return spark.createDataFrame(
        [(v, d, ts(t), wei(a)) for v, d, t, a in items],
        "validator_id bigint, delegator_address string, block_timestamp timestamp_ntz, amount_raw decimal(38,0)",
    )


def test_earnings_use_previous_snapshot_and_own_claims(spark):
    snaps = self_snapshots(spark, (1, 1, 10.0, 2.0), (1, 4, 7.0, 3.0))
    claims = claim_rows(spark, (1, "0xA", "04T01:00:00", "5"), (1, "0xother", "04T02:00:00", "50"))
    created = spark.createDataFrame([(1, "0xa")], "validator_id bigint, auth_address string")
    fees = spark.createDataFrame(
        [(1, ts("04T00:00:00"), 0.5), (None, ts("04T00:00:00"), 9.0)],
        "validator_id bigint, block_timestamp timestamp_ntz, total_priority_fee double",
    )
    out = rows(earnings.ez_validator_earnings(snaps, claims, created, fees))
    assert len(out) == 1
    r = out[0]
    assert (r["earning_date"], r["prev_snapshot_date"]) == (day(4), day(1))
    assert (r["claimed_rewards"], r["unclaimed_change"], r["priority_fees"], r["total_earned"]) == (5.0, -3.0, 0.5, 2.5)
    assert r["total_earned_usd"] == 7.5 and r["claim_count"] == 1 and r["blocks_produced"] == 1


def test_rolling_apr_counts_rows(spark):
    earned = spark.createDataFrame(
        [(1, day(d), e, e, 1.0) for d, e in [(1, 1.0), (20, 3.0)]],
        "validator_id bigint, earning_date date, total_earned double, total_earned_usd double, mon_price_usd double",
    )
    states = spark.createDataFrame(
        [(1, day(1), 100.0, 100.0), (1, day(20), 100.0, 100.0), (1, day(21), 0.0, 0.0)],
        "validator_id bigint, snapshot_date date, execution_stake double, execution_stake_usd double",
    )
    out = rows(earnings.ez_validator_apr(earned, states), "earning_date")
    assert [r["apr_pct"] for r in out] == [365.0, 1095.0]
    assert [r["apr_7d_rolling_pct"] for r in out] == [365.0, 730.0]


@pytest.mark.parametrize("price,unclaimed,earned,expected", [
    (13.0, 1.0, 1.0, decisions.SELL), (7.0, 1.0, 1.0, decisions.COMPOUND),
    (10.0, 99.0, 1.0, decisions.CLAIM), (10.0, 1.0, 1.0, decisions.NEUTRAL),
    (10.0, 1.0, None, decisions.NEUTRAL),
])
def test_recommendations(spark, price, unclaimed, earned, expected):
    quotes = prices(spark, *[(f"0{d}T00:00:00", 10.0, True) for d in range(1, 6)])
    created = spark.createDataFrame([(1, "0xa")], "validator_id bigint, auth_address string")
    income = spark.createDataFrame([(1, day(2), earned)], "validator_id bigint, earning_date date, total_earned double")
    out = rows(decisions.ez_compound_decision(
        self_snapshots(spark, (1, 5, unclaimed, price)), quotes,
        claim_rows(spark, (1, "0xa", "03T23:00:00", "5")), created, income, as_of=AS_OF,
    ))[0]
    assert out["recommendation"] == expected
    assert out["days_since_last_claim"] == 3 and out["claimed_amount_30d"] == 5.0


def test_volatility_rule_comes_before_claim(spark):
    quotes = prices(spark, ("01T00:00:00", 5.0, True), ("02T00:00:00", 15.0, True))
    created = spark.createDataFrame([(1, "0xa")], "validator_id bigint, auth_address string")
    income = spark.createDataFrame([(1, day(2), 1.0)], "validator_id bigint, earning_date date, total_earned double")
    out = rows(decisions.ez_compound_decision(
        self_snapshots(spark, (1, 5, 99.0, 10.0)), quotes, claim_rows(spark, (2, "x", "01T00:00:00", "1")),
        created, income, as_of=AS_OF,
    ))[0]
    assert out["recommendation"] == decisions.PARTIAL and out["claims_last_30d"] == 0


def test_requests_and_page_offsets(spark):
    created = spark.createDataFrame([(17, "0x00ab")], "validator_id bigint, auth_address string")
    days = spark.createDataFrame([(day(3), 255)], "snapshot_date date, snapshot_block bigint")
    asked = rows(snapshots.delegator_requests(created, days))[0]
    assert asked["calldata"] == "0x573c1ce0" + f"{17:064x}" + f"{0xAB:064x}"
    body = json.loads(asked["request"])
    assert body["params"] == [{"to": STAKING_CONTRACT, "data": asked["calldata"]}, "0xff"]
    assert body["id"] == "getDelegator-17-2024-01-03" and body["method"] == "eth_call"
    epochs = spark.createDataFrame([(4, 16)], "epoch bigint, epoch_start_block bigint")
    pages = rows(snapshots.set_requests(epochs, (0, 100)), "start_index")
    assert [p["calldata"][-2:] for p in pages] == ["00", "64"]


def test_validator_names_prefer_labels(chain):
    dim = rows(chain.validators, "validator_id")
    by_id = {r["validator_id"]: r for r in dim}
    assert by_id[3]["validator_name"] == "Supplier#000000003"
    assert by_id[4]["validator_name"] == "Customer#000000004"
    assert by_id[5]["consensus_address"] is None and by_id[7]["secp_pubkey"] is None
    assert {r["status"] for r in dim} <= {"active", "stake_too_low", "unknown"}
    assert validators.enrich(chain.epochs, None) is chain.epochs


def test_volatility_of_large_close_prices(spark):
    import statistics
    from decimal import Decimal as D

    from stakeflow.plans import decisions

    prices = [60000 + (0.01 if i % 2 else -0.01) + (i % 7) * 0.001 for i in range(700)]
    rows = [(dt.datetime(2024, 1, 31) - dt.timedelta(hours=i), p, True) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "hour timestamp_ntz, price double, is_native boolean")
    found = decisions.price_trend(df, dt.datetime(2024, 1, 31, 0, 30)).first()["price_volatility_30d"]
    assert found == pytest.approx(float(statistics.stdev([D(repr(p)) for p in prices])), rel=1e-9)
