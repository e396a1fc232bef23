"""DuckDB SQL for the registered queries, written independently of the Spark code.

Shared relations are named here once; ``statement`` puts those a query mentions
in front of it. All sums are exact (integers or decimals) and rounding is half
up on the shortest decimal text, as in Spark, so that values compare bit by bit.
"""

from __future__ import annotations

import re

from stakeflow.plans.decisions import CLAIM, COMPOUND, NEUTRAL, PARTIAL, SELL
from stakeflow.sources.samples import OTHER_CONTRACT, OTHER_SELECTOR, SAMPLE_ADDRESSES, SAMPLE_KEYS
from stakeflow.sources.tables import REWARD_SELECTOR, STAKING_CONTRACT


def rnd(x: str, n: int = 0) -> str:
    return f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,{n})) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def tok(raw: str) -> str:
    return f"({dbl(raw)} / 1e18)"


def raw(cents: str) -> str:
    return f"CAST(CAST({cents} AS HUGEINT) * 10000000000000000 AS DECIMAL(38,0))"


def wide(cents: str) -> str:
    return f"CAST(CAST({cents} AS HUGEINT) * 72057594037927936 AS DECIMAL(38,0))"


def exact(x: str) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))"


def xsum(x: str, over: str = "") -> str:
    return dbl(f"SUM({exact(x)}) {over}")


def xavg(x: str, over: str = "") -> str:
    return f"({xsum(x, over)} / NULLIF(COUNT({x}) {over}, 0))"


def key(*cols: str) -> str:
    parts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '_null_')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def text_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def block_time(n: str) -> str:
    return f"(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(({n} * 173) % 2592000))"


def seconds(a: str, b: str) -> str:
    return f"date_diff('second', {a}, {b})"


AS_OF = "DATE '2024-01-31'"
NOW = "TIMESTAMP '2024-01-31 00:00:00'"

EVENT_HEAD = """event_id AS block_number, ts AS block_timestamp,
    '0x' || md5(CAST(event_id AS VARCHAR)) AS tx_hash, CAST(0 AS INTEGER) AS event_index,
    '{contract}' AS contract_address, event_name""".format(contract=STAKING_CONTRACT)
EVENT_TAIL = """'0xorigin' AS origin_from_address, '{contract}' AS origin_to_address,
    '{selector}' AS origin_function_signature""".format(
    contract=STAKING_CONTRACT, selector=OTHER_SELECTOR
)


def event_fact(name: str, key_name: str, fields: str) -> str:
    tx = "'0x' || md5(CAST(event_id AS VARCHAR))"
    return (
        f"SELECT {EVENT_HEAD}, vid AS validator_id, {fields}, {EVENT_TAIL}, "
        f"{key(tx, '0')} AS {key_name} FROM act WHERE event_name = '{name}'"
    )


def order_log(hash_text: str, name: str, selector: str, fields: str, key_name: str, where: str) -> str:
    tx = f"'0x' || md5({hash_text})"
    return f"""SELECT o_orderkey AS block_number, {block_time('o_orderkey')} AS block_timestamp,
        {tx} AS tx_hash, CAST(0 AS INTEGER) AS event_index,
        '{STAKING_CONTRACT}' AS contract_address, '{name}' AS event_name, {fields},
        '0xorigin' AS origin_from_address, '{STAKING_CONTRACT}' AS origin_to_address,
        {selector} AS origin_function_signature, {key(tx, '0')} AS {key_name}
        FROM orders WHERE {where}"""


REL: dict[str, str] = {}

REL["ev"] = """SELECT event_id, ts, user_id, event_type, value,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CAST(round(value * 100) AS BIGINT) AS cents, CAST(ts AS DATE) AS day,
    user_id % 20 AS vid, '0xd' || CAST(user_id AS VARCHAR) AS wallet FROM events"""

REL["named"] = """SELECT *, CASE WHEN event_type = 'purchase' THEN 'Delegate'
      WHEN event_type = 'click' THEN 'Undelegate' WHEN event_type = 'view' THEN 'Withdraw'
      WHEN event_type = 'signup' THEN 'ClaimRewards' WHEN k < 10 THEN 'CommissionChanged'
      WHEN k < 20 THEN 'ValidatorStatusChanged' ELSE 'ValidatorRewarded' END AS event_name
    FROM ev"""
REL["act"] = "SELECT * FROM named WHERE event_id % 50 <> 0 AND event_id % 53 <> 0"

EPOCH = "CAST(day(ts) AS BIGINT)"
AMOUNT = f"{raw('cents')} AS amount_raw, {tok(raw('cents'))} AS amount"

REL["created"] = f"""SELECT n AS block_number, t AS block_timestamp,
    '0x' || md5('created-' || CAST(vid AS VARCHAR)) AS tx_hash, CAST(0 AS INTEGER) AS event_index,
    '{STAKING_CONTRACT}' AS contract_address, 'ValidatorCreated' AS event_name,
    vid AS validator_id, '0xd' || CAST(vid AS VARCHAR) AS auth_address,
    {raw('vid + 1')} AS commission, {EVENT_TAIL},
    {key("'0x' || md5('created-' || CAST(vid AS VARCHAR))", "0")} AS fact_validators_created_id
    FROM (SELECT vid, MIN(event_id) AS n, MIN(ts) AS t FROM ev GROUP BY vid)"""
REL["delegations"] = event_fact(
    "Delegate", "fact_delegations_id",
    f"wallet AS delegator_address, {AMOUNT}, {EPOCH} AS activation_epoch")
REL["undelegations"] = event_fact(
    "Undelegate", "fact_undelegations_id",
    f"wallet AS delegator_address, k % 4 AS withdraw_id, {AMOUNT}, {EPOCH} AS activation_epoch")
REL["withdrawals"] = event_fact(
    "Withdraw", "fact_withdrawals_id",
    f"wallet AS delegator_address, k % 4 AS withdraw_id, {AMOUNT}, {EPOCH} AS withdraw_epoch")
REL["claims"] = event_fact(
    "ClaimRewards", "fact_rewards_claimed_id",
    f"wallet AS delegator_address, {AMOUNT}, {EPOCH} AS epoch")
REL["commission_changes"] = event_fact(
    "CommissionChanged", "fact_validator_commission_changes_id",
    f"{raw('k')} AS old_commission, {raw('k + 1')} AS new_commission")
REL["status_changes"] = event_fact(
    "ValidatorStatusChanged", "fact_validator_status_changes_id",
    "CAST(k % 2 AS DECIMAL(38,0)) AS flags")
REL["other_rewards"] = event_fact(
    "ValidatorRewarded", "fact_validator_rewards_id",
    f"wallet AS reward_source, {AMOUNT}, {EPOCH} AS epoch")
# The first block of each epoch, whichever it is.
FIRST_OF_EPOCH = "o_orderkey IN (SELECT MIN(o_orderkey) FROM orders GROUP BY o_orderkey // 500)"
PRICE_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
REL["block_rewards"] = order_log(
    "'block-' || CAST(o_orderkey AS VARCHAR)", "ValidatorRewarded",
    f"CASE WHEN o_orderkey % 10 = 9 THEN '{OTHER_SELECTOR}' ELSE '{REWARD_SELECTOR}' END",
    f"o_custkey % 20 AS validator_id, '{STAKING_CONTRACT}' AS reward_source, "
    f"{raw(PRICE_CENTS)} AS amount_raw, {tok(raw(PRICE_CENTS))} AS amount, o_orderkey // 500 AS epoch",
    "fact_validator_rewards_id", "TRUE")
REL["rewards"] = "SELECT * FROM other_rewards UNION ALL BY NAME SELECT * FROM block_rewards"
REL["producers"] = f"""SELECT * FROM rewards WHERE origin_to_address = '{STAKING_CONTRACT}'
    AND origin_function_signature = '{REWARD_SELECTOR}'"""
REL["epoch_changes"] = order_log(
    "'epoch-' || CAST(o_orderkey // 500 AS VARCHAR)", "EpochChanged", f"'{OTHER_SELECTOR}'",
    "o_orderkey // 500 - 1 AS old_epoch, o_orderkey // 500 AS new_epoch",
    "fact_epoch_changes_id", FIRST_OF_EPOCH)

REL["chain_blocks"] = """SELECT o_orderkey AS block_number,
    '0xm' || CAST((o_orderkey // 700) % 3 AS VARCHAR) AS miner,
    CAST((o_orderkey % 50) * 1000000000 AS BIGINT) AS base_wei FROM orders"""
REL["txs"] = f"""SELECT l_orderkey AS block_number, {block_time('l_orderkey')} AS block_timestamp,
    CAST(l_quantity AS BIGINT) AS gas_used, l_extendedprice / 1000 AS effective_gas_price,
    l_shipdate AS modified_timestamp FROM lineitem"""

REL["price_hours"] = """SELECT date_trunc('hour', ts) AS hour, MAX(value) AS price
    FROM ev GROUP BY 1"""
REL["closes"] = """SELECT CAST(hour AS DATE) AS price_date, arg_max(price, hour) AS mon_price_usd
    FROM price_hours GROUP BY 1"""
REL["last_price"] = "SELECT COALESCE(arg_max(price, hour), 0) AS p FROM price_hours"

REL["states"] = """SELECT * FROM (SELECT vid, day, CAST(SUM(cents) AS BIGINT) AS all_cents,
      COUNT(*) AS n,
      CAST(COALESCE(SUM(cents) FILTER (event_type = 'purchase'), 0) AS BIGINT) AS in_cents,
      CAST(COALESCE(SUM(cents) FILTER (event_type = 'click'), 0) AS BIGINT) AS out_cents,
      MAX(event_id) AS last_block, vid + day(day) AS mark, CAST(day(day) AS BIGINT) AS dom
    FROM ev GROUP BY vid, day) WHERE mark % 13 <> 0 AND mark % 17 <> 0"""

BPS = "10000000000000000"
REL["decoded"] = f"""SELECT day AS snapshot_date, vid AS validator_id, last_block AS snapshot_block,
    '0x' || lpad(lower(to_hex(vid + 256)), 40, '0') AS auth_address,
    CAST(vid % 3 AS DECIMAL(38,0)) AS flags,
    {wide('1000000000 + all_cents')} AS execution_stake_raw,
    {tok(wide('1000000000 + all_cents'))} AS execution_stake,
    CASE WHEN mark % 5 <> 0 THEN {wide('n')} END AS accumulated_rewards_per_token_raw,
    {raw('vid + 1')} AS execution_commission_bps,
    {dbl(raw('vid + 1'))} / 1e16 AS execution_commission_pct,
    {wide('all_cents')} AS unclaimed_rewards_raw, {tok(wide('all_cents'))} AS unclaimed_rewards,
    {wide('1000000000 + all_cents + in_cents')} AS consensus_stake_raw,
    {tok(wide('1000000000 + all_cents + in_cents'))} AS consensus_stake,
    {raw('vid + 2')} AS consensus_commission_bps,
    {dbl(raw('vid + 2'))} / 1e16 AS consensus_commission_pct,
    {wide('1000000000 + all_cents - out_cents')} AS snapshot_stake_raw,
    {tok(wide('1000000000 + all_cents - out_cents'))} AS snapshot_stake,
    {raw('vid + 3')} AS snapshot_commission_bps,
    {dbl(raw('vid + 3'))} / 1e16 AS snapshot_commission_pct,
    CASE WHEN vid = 7 THEN NULL
         WHEN vid = 5 THEN '0x02' || repeat('00', 31) || '05'
         ELSE '0x' || list_extract({text_list(SAMPLE_KEYS)}, CAST(vid % 10 + 1 AS BIGINT)) END
      AS secp_pubkey,
    '0x' || substr(sha256(CAST(vid AS VARCHAR)) || md5(CAST(vid AS VARCHAR)), 1, 96) AS bls_pubkey,
    {key('day', 'vid')} AS snapshot_get_validator_id FROM states"""
REL["vsnaps"] = f"""SELECT d.* EXCLUDE (snapshot_get_validator_id),
    {rnd('execution_stake * mon_price_usd', 2)} AS execution_stake_usd,
    {rnd('unclaimed_rewards * mon_price_usd', 2)} AS unclaimed_rewards_usd,
    {rnd('consensus_stake * mon_price_usd', 2)} AS consensus_stake_usd,
    {rnd('snapshot_stake * mon_price_usd', 2)} AS snapshot_stake_usd,
    mon_price_usd, {key('snapshot_date', 'validator_id')} AS fact_validator_snapshots_id
    FROM decoded d LEFT JOIN closes ON price_date = snapshot_date"""
REL["self_raw"] = f"""SELECT day AS snapshot_date, vid AS validator_id,
    '0xd' || CAST(vid AS VARCHAR) AS auth_address, last_block AS snapshot_block,
    {wide('in_cents + 1000')} AS stake_raw,
    CASE WHEN mark % 5 <> 0 THEN CAST(n AS DECIMAL(38,0)) END AS acc_reward_per_token_raw,
    {wide('all_cents')} AS unclaimed_rewards_raw, {wide('in_cents')} AS delta_stake_raw,
    {wide('out_cents')} AS next_delta_stake_raw, CAST(dom AS DECIMAL(38,0)) AS delta_epoch,
    CAST(dom + 1 AS DECIMAL(38,0)) AS next_delta_epoch,
    {tok(wide('in_cents + out_cents'))} AS total_pending_stake FROM states"""
REL["self_snaps"] = f"""SELECT s.*, {tok('stake_raw')} AS stake,
    {rnd(tok('stake_raw') + ' * mon_price_usd', 2)} AS stake_usd,
    {tok('unclaimed_rewards_raw')} AS unclaimed_rewards,
    {rnd(tok('unclaimed_rewards_raw') + ' * mon_price_usd', 2)} AS unclaimed_rewards_usd,
    {tok('delta_stake_raw')} AS delta_stake, {tok('next_delta_stake_raw')} AS next_delta_stake,
    mon_price_usd,
    {key('snapshot_date', 'validator_id')} AS fact_validator_self_delegation_snapshots_id
    FROM self_raw s LEFT JOIN closes ON price_date = snapshot_date"""

REL["addresses"] = f"""SELECT c.validator_id, c.auth_address,
    CASE WHEN s.d IS NOT NULL AND c.validator_id NOT IN (5, 7) THEN
      list_extract({text_list(SAMPLE_ADDRESSES)}, CAST(c.validator_id % 10 + 1 AS BIGINT)) END
      AS consensus_address,
    CASE WHEN c.validator_id NOT IN (5, 7) THEN s.k END AS secp_pubkey,
    CASE WHEN c.validator_id NOT IN (5, 7) THEN s.d END AS address_snapshot_date,
    c.block_timestamp AS validator_created_at, {key('c.validator_id')} AS validator_addresses_id
    FROM created c LEFT JOIN (SELECT validator_id, MAX(snapshot_date) AS d,
      arg_max(secp_pubkey, snapshot_date) AS k FROM decoded WHERE secp_pubkey IS NOT NULL
      GROUP BY 1) s ON s.validator_id = c.validator_id"""
REL["names"] = f"""SELECT upper(list_extract({text_list(SAMPLE_ADDRESSES)},
    CAST(s_suppkey % 10 + 1 AS BIGINT))) AS address, s_name AS address_name FROM supplier
    WHERE s_suppkey < 10 AND s_suppkey % 3 = 0"""
REL["locations"] = """SELECT c_custkey AS validator_id, c_name AS validator_name,
    'https://' || lower(c_mktsegment) AS website, CAST(NULL AS VARCHAR) AS image,
    CASE WHEN c_custkey % 5 <> 4 THEN 'City, ' || CAST(c_custkey AS VARCHAR) END AS city,
    CAST(c_nationkey AS VARCHAR) AS region, c_mktsegment AS country, 'UTC' AS timezone,
    c_acctbal AS latitude, c_acctbal * -1 AS longitude, CAST(NULL AS VARCHAR) AS ip_address
    FROM customer"""
REL["validators"] = f"""SELECT c.validator_id,
    COALESCE(n.address_name, m.validator_name) AS validator_name, c.auth_address,
    a.consensus_address, c.block_timestamp AS created_at, c.block_number AS created_block,
    c.tx_hash AS creation_tx_hash, {tok('c.commission')} * 100 AS initial_commission_pct,
    l.execution_commission_pct AS current_commission_pct, l.consensus_commission_pct, l.flags,
    CASE WHEN l.flags = 0 THEN 'active' WHEN l.flags = 1 THEN 'stake_too_low' ELSE 'unknown' END
      AS status,
    l.secp_pubkey, l.bls_pubkey, l.snapshot_date AS latest_snapshot_date, m.website, m.image,
    m.city, m.region, m.country, m.timezone, m.latitude, m.longitude, m.ip_address,
    {key('c.validator_id')} AS gov__dim_validators_id
    FROM created c LEFT JOIN addresses a ON a.validator_id = c.validator_id
    LEFT JOIN (SELECT * FROM decoded QUALIFY
      ROW_NUMBER() OVER (PARTITION BY validator_id ORDER BY snapshot_date DESC) = 1) l
      ON l.validator_id = c.validator_id
    LEFT JOIN names n ON lower(n.address) = lower(a.consensus_address)
    LEFT JOIN locations m ON m.validator_id = c.validator_id"""

REL["epochs"] = f"""SELECT epoch, epoch_start_block, epoch_end_block,
    epoch_end_block - epoch_start_block + 1 AS epoch_block_count, epoch_start_timestamp,
    epoch_end_timestamp, {seconds('epoch_start_timestamp', 'epoch_end_timestamp')}
      AS epoch_duration_seconds, epoch_change_tx_hash
    FROM (SELECT new_epoch AS epoch, block_number AS epoch_start_block,
      block_timestamp AS epoch_start_timestamp, tx_hash AS epoch_change_tx_hash,
      COALESCE(LEAD(block_number) OVER (ORDER BY new_epoch) - 1,
        (SELECT MAX(block_number) FROM chain_blocks)) AS epoch_end_block,
      LEAD(block_timestamp) OVER (ORDER BY new_epoch) AS epoch_end_timestamp FROM epoch_changes)"""

REL["miner_base"] = """SELECT r.block_number, r.block_timestamp, r.validator_id, b.miner,
    LAG(b.miner) OVER (PARTITION BY r.validator_id ORDER BY r.block_number) AS before
    FROM producers r JOIN chain_blocks b ON b.block_number = r.block_number"""
REL["miner_groups"] = """SELECT *, SUM(CASE WHEN before IS NULL OR before <> miner THEN 1 ELSE 0 END)
    OVER (PARTITION BY validator_id ORDER BY block_number) AS g FROM miner_base"""
REL["miners"] = f"""SELECT *, {seconds('start_timestamp', 'end_timestamp')} AS duration_seconds,
    ROW_NUMBER() OVER (PARTITION BY validator_id ORDER BY start_block DESC) = 1 AS is_current,
    LEAD(miner) OVER (PARTITION BY validator_id ORDER BY start_block) AS next_miner,
    {key('validator_id', 'miner', 'start_block')} AS dim_miner_validators_id
    FROM (SELECT validator_id, miner, MIN(block_number) AS start_block,
      MAX(block_number) AS end_block, MIN(block_timestamp) AS start_timestamp,
      MAX(block_timestamp) AS end_timestamp, COUNT(*) AS blocks_produced
      FROM miner_groups GROUP BY validator_id, miner, g)"""

REL["tx_over"] = """SELECT t.block_number, t.block_timestamp, b.miner, b.base_wei, t.gas_used,
    CAST(round(t.effective_gas_price * 1e9) AS BIGINT) - b.base_wei AS over_wei
    FROM txs t JOIN chain_blocks b ON b.block_number = t.block_number"""
REL["fee_blocks"] = """SELECT block_number, block_timestamp, miner, base_wei, COUNT(*) AS tx_count,
    CAST(COUNT(*) FILTER (over_wei > 0 AND gas_used > 0) AS BIGINT) AS tx_count_with_priority_fee,
    CAST(SUM(gas_used) AS BIGINT) AS total_gas_used,
    SUM(CAST(over_wei AS HUGEINT) * gas_used) AS fees, SUM(CAST(over_wei AS HUGEINT)) AS sum_over,
    MIN(over_wei) AS min_over, MAX(over_wei) AS max_over
    FROM tx_over GROUP BY block_number, block_timestamp, miner, base_wei"""
REL["fees"] = f"""SELECT f.block_number, f.block_timestamp, p.validator_id, p.epoch, f.miner,
    CAST(f.base_wei AS DOUBLE) / 1e9 AS base_fee_per_gas, tx_count, tx_count_with_priority_fee,
    total_gas_used, {tok('fees')} AS total_priority_fee,
    {dbl('sum_over')} / tx_count / 1e9 / 1e9 AS avg_priority_fee_per_gas,
    {dbl('min_over')} / 1e9 / 1e9 AS min_priority_fee_per_gas,
    {dbl('max_over')} / 1e9 / 1e9 AS max_priority_fee_per_gas,
    {key('f.block_number')} AS fact_block_priority_fees_id
    FROM fee_blocks f LEFT JOIN producers p ON p.block_number = f.block_number"""

REL["production"] = f"""SELECT epoch, validator_id, COUNT(*) AS blocks_produced,
    {tok('SUM(amount_raw)')} AS total_block_rewards, SUM(amount_raw) AS total_block_rewards_raw,
    {tok('SUM(amount_raw)')} / COUNT(*) AS avg_reward_per_block,
    MIN(block_number) AS first_block_produced, MAX(block_number) AS last_block_produced,
    MIN(block_timestamp) AS first_block_timestamp, MAX(block_timestamp) AS last_block_timestamp,
    {key('epoch', 'validator_id')} AS ez_block_production_id
    FROM producers GROUP BY epoch, validator_id"""

REL["validator_set"] = f"""SELECT epoch, epoch_start_block, v AS validator_id, pos - 1 AS validator_position,
    {key('epoch', 'v')} AS snapshot_validator_set_id
    FROM (SELECT o_orderkey // 500 AS epoch, o_orderkey AS epoch_start_block, v,
      ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY v) AS pos
      FROM orders, range(0, 20) AS r(v)
      WHERE {FIRST_OF_EPOCH} AND (o_orderkey // 500 + v) % 5 <> 0) WHERE pos <= 20"""
REL["epoch_stakes"] = """SELECT s.epoch, s.validator_id, s.validator_position,
    c.auth_address AS validator_address, e.epoch_block_count, e.epoch_start_timestamp,
    e.epoch_end_timestamp, COALESCE(p.snapshot_stake, d.snapshot_stake, 0) AS validator_stake
    FROM validator_set s JOIN created c ON c.validator_id = s.validator_id
    JOIN epochs e ON e.epoch = s.epoch
    LEFT JOIN decoded p ON p.validator_id = s.validator_id
      AND p.snapshot_date = CAST(e.epoch_start_timestamp AS DATE) - 1
    LEFT JOIN decoded d ON d.validator_id = s.validator_id
      AND d.snapshot_date = CAST(e.epoch_start_timestamp AS DATE)
    WHERE e.epoch_start_timestamp >= c.block_timestamp"""
REL["epoch_sums"] = f"""SELECT epoch, {xsum('validator_stake')} AS total_epoch_stake,
    COUNT(DISTINCT validator_id) AS validators_in_snapshot FROM epoch_stakes GROUP BY epoch"""
SHARE = "(s.validator_stake / NULLIF(t.total_epoch_stake, 0))"
REL["performance"] = f"""SELECT s.epoch, s.validator_id, s.validator_position, s.validator_address,
    t.validators_in_snapshot, s.epoch_block_count AS total_epoch_blocks, s.validator_stake,
    t.total_epoch_stake, {rnd(SHARE, 6)} AS stake_weight,
    {rnd(f's.epoch_block_count * {SHARE}', 2)} AS expected_blocks_per_validator,
    COALESCE(b.blocks_produced, 0) AS actual_blocks_produced,
    COALESCE(b.blocks_produced, 0) - {rnd(f's.epoch_block_count * {SHARE}', 0)}
      AS blocks_vs_expected,
    {rnd('100.0::DOUBLE * COALESCE(b.blocks_produced, 0) / NULLIF(s.epoch_block_count, 0)', 4)}
      AS pct_of_epoch_blocks,
    {rnd('100.0::DOUBLE * s.validator_stake / NULLIF(t.total_epoch_stake, 0)', 4)}
      AS expected_pct_of_epoch_blocks,
    CAST(RANK() OVER (PARTITION BY s.epoch ORDER BY COALESCE(b.blocks_produced, 0) DESC)
      AS INTEGER) AS production_rank,
    COALESCE(b.total_block_rewards, 0) AS total_block_rewards,
    COALESCE(b.avg_reward_per_block, 0) AS avg_reward_per_block,
    s.epoch_start_timestamp, s.epoch_end_timestamp,
    {key('s.epoch', 's.validator_id')} AS ez_validator_epoch_performance_id
    FROM epoch_stakes s JOIN epoch_sums t ON t.epoch = s.epoch
    LEFT JOIN production b ON b.epoch = s.epoch AND b.validator_id = s.validator_id"""

REL["own_claims"] = """SELECT c.* FROM claims c JOIN created v ON v.validator_id = c.validator_id
    AND v.auth_address = c.delegator_address"""
REL["claim_days"] = """SELECT validator_id, CAST(block_timestamp AS DATE) AS d,
    SUM(amount_raw) AS claimed_raw, COUNT(*) AS claim_count FROM own_claims GROUP BY 1, 2"""
REL["fee_days"] = f"""SELECT validator_id, CAST(block_timestamp AS DATE) AS d,
    {xsum('total_priority_fee')} AS total_fees, COUNT(*) AS blocks_produced
    FROM fees WHERE validator_id IS NOT NULL GROUP BY 1, 2"""
REL["self_lags"] = """SELECT *, LAG(unclaimed_rewards) OVER w AS prev_unclaimed,
    LAG(snapshot_date) OVER w AS prev_snapshot_date FROM self_snaps
    WINDOW w AS (PARTITION BY validator_id ORDER BY snapshot_date)"""
REL["earn_parts"] = f"""SELECT s.validator_id, s.snapshot_date AS earning_date, s.stake AS self_stake,
    COALESCE({tok('c.claimed_raw')}, 0) AS claimed_rewards,
    COALESCE(c.claimed_raw, 0) AS claimed_rewards_raw, COALESCE(c.claim_count, 0) AS claim_count,
    s.unclaimed_rewards - s.prev_unclaimed AS unclaimed_change,
    COALESCE(f.total_fees, 0) AS priority_fees, COALESCE(f.blocks_produced, 0) AS blocks_produced,
    s.unclaimed_rewards AS unclaimed_balance, s.unclaimed_rewards_usd AS unclaimed_balance_usd,
    s.mon_price_usd, s.prev_snapshot_date FROM self_lags s
    LEFT JOIN claim_days c ON c.validator_id = s.validator_id AND c.d = s.snapshot_date
    LEFT JOIN fee_days f ON f.validator_id = s.validator_id AND f.d = s.snapshot_date
    WHERE s.prev_unclaimed IS NOT NULL"""
REL["earnings"] = f"""SELECT *, claimed_rewards + unclaimed_change + priority_fees AS total_earned,
    (claimed_rewards + unclaimed_change + priority_fees) * mon_price_usd AS total_earned_usd,
    priority_fees * mon_price_usd AS priority_fees_usd,
    {key('validator_id', 'earning_date')} AS ez_validator_earnings_id FROM earn_parts"""
REL["rates"] = """SELECT e.validator_id, e.earning_date, e.total_earned, e.total_earned_usd,
    s.execution_stake, s.execution_stake_usd, e.mon_price_usd,
    e.total_earned / s.execution_stake AS daily_return_rate
    FROM earnings e JOIN vsnaps s ON s.validator_id = e.validator_id
      AND s.snapshot_date = e.earning_date WHERE s.execution_stake > 0"""


def frame(n: int) -> str:
    return (
        "OVER (PARTITION BY validator_id ORDER BY earning_date "
        f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    )


REL["apr"] = f"""SELECT *, {rnd('daily_return_rate * 365 * 100', 4)} AS apr_pct,
    {rnd('(pow(1 + daily_return_rate, 365) - 1) * 100', 4)} AS apy_pct,
    {rnd(xavg('daily_return_rate', frame(7)) + ' * 365 * 100', 4)} AS apr_7d_rolling_pct,
    {rnd(xavg('daily_return_rate', frame(30)) + ' * 365 * 100', 4)} AS apr_30d_rolling_pct,
    {key('validator_id', 'earning_date')} AS ez_validator_apr_id FROM rates"""

REL["avg_earned"] = f"""SELECT validator_id, {xavg('total_earned')} AS avg_daily_commission_mon
    FROM earnings GROUP BY 1"""
MISSED = """CASE WHEN expected_blocks_per_validator IS NULL THEN NULL
    ELSE greatest(expected_blocks_per_validator - actual_blocks_produced, 0) END"""
LOST = f"({MISSED}) / expected_blocks_per_validator * COALESCE(c.avg_daily_commission_mon, 0)"
REL["miss_rate"] = f"""SELECT p.epoch, p.validator_id, validator_address, validators_in_snapshot,
    total_epoch_blocks, expected_blocks_per_validator, actual_blocks_produced, blocks_vs_expected,
    pct_of_epoch_blocks, production_rank, {MISSED} AS missed_blocks,
    CASE WHEN expected_blocks_per_validator > 0 THEN
      {rnd(f'({MISSED}) / expected_blocks_per_validator * 100', 2)} ELSE 0 END AS miss_rate_pct,
    CASE WHEN expected_blocks_per_validator > 0 THEN
      {rnd('least(actual_blocks_produced / expected_blocks_per_validator, 1) * 100', 2)}
      ELSE 100 END AS uptime_pct,
    c.avg_daily_commission_mon,
    CASE WHEN expected_blocks_per_validator > 0 THEN {rnd(LOST, 4)} ELSE 0 END
      AS estimated_missed_commission_mon,
    CASE WHEN expected_blocks_per_validator > 0 THEN {rnd(LOST + ' * (SELECT p FROM last_price)', 2)}
      ELSE 0 END AS estimated_missed_commission_usd,
    (SELECT p FROM last_price) AS mon_price_usd, epoch_start_timestamp, epoch_end_timestamp,
    {key('p.epoch', 'p.validator_id')} AS ez_miss_rate_id
    FROM performance p LEFT JOIN avg_earned c ON c.validator_id = p.validator_id"""

REL["recent_stats"] = f"""SELECT validator_id, validator_address AS auth_address,
    AVG(actual_blocks_produced) AS avg_blocks_per_epoch,
    {xavg('pct_of_epoch_blocks')} AS avg_pct_share,
    {xavg('total_block_rewards')} AS avg_rewards_per_epoch, COUNT(*) AS epochs_analyzed
    FROM performance WHERE epoch >= (SELECT MAX(epoch) FROM performance) - 10 GROUP BY 1, 2"""
REL["typical_epoch"] = """SELECT AVG(epoch_block_count) AS b, AVG(epoch_duration_seconds) AS s
    FROM epochs WHERE epoch IN (SELECT epoch FROM performance)
      AND epoch >= (SELECT MAX(epoch) FROM performance) - 10
      AND epoch_duration_seconds > 0 AND epoch_block_count > 0"""
REL["month_earned"] = f"""SELECT validator_id, {xavg('total_earned')} AS avg_daily,
    {xsum('total_earned')} AS earned FROM earnings
    WHERE earning_date >= {AS_OF} - 30 GROUP BY 1"""


def restart_columns() -> str:
    out = []
    for m, suffix in [(5, "5min"), (15, "15min"), (30, "30min"), (60, "1hr")]:
        lost = f"COALESCE(c.avg_daily, 0) * ({m}.0::DOUBLE / 1440)"
        out += [
            f"{rnd(f'{60 * m}.0::DOUBLE / NULLIF(t.s, 0) * v.avg_blocks_per_epoch')} AS missed_blocks_{suffix}",
            f"{rnd(lost, 6)} AS loss_mon_{suffix}",
            f"{rnd(f'{lost} * (SELECT p FROM last_price)', 2)} AS loss_usd_{suffix}",
        ]
    return ", ".join(out)


REL["restart"] = f"""SELECT v.*, t.b AS avg_epoch_blocks, t.s AS avg_epoch_seconds,
    c.avg_daily AS avg_daily_commission_mon, (SELECT p FROM last_price) AS mon_price_usd,
    {restart_columns()}, {key('v.validator_id')} AS ez_restart_impact_id
    FROM recent_stats v CROSS JOIN typical_epoch t
    LEFT JOIN month_earned c ON c.validator_id = v.validator_id"""

UNITS = "CAST(CAST(price AS DECIMAL(19,9)) * 1000000000 AS HUGEINT)"
REL["trend"] = f"""SELECT
    {xavg(f"CASE WHEN hour >= {NOW} - INTERVAL 1 DAY THEN price END")} AS price_1d_avg,
    {xavg(f"CASE WHEN hour >= {NOW} - INTERVAL 7 DAY THEN price END")} AS price_7d_avg,
    {xavg('price')} AS price_30d_avg, MIN(price) AS price_30d_low, MAX(price) AS price_30d_high,
    CASE WHEN COUNT(price) > 1 THEN sqrt(GREATEST(0.0::DOUBLE, CAST(CAST(
      COUNT(price) * SUM({UNITS} * {UNITS}) - SUM({UNITS}) * SUM({UNITS}) AS VARCHAR) AS DOUBLE)
      ) / (COUNT(price) * (COUNT(price) - 1))) / CAST(1e9 AS DOUBLE) END AS price_volatility_30d
    FROM price_hours WHERE hour >= {NOW} - INTERVAL 30 DAY"""
REL["recent_claims"] = f"""SELECT validator_id, COUNT(*) AS n, {tok('SUM(amount_raw)')} AS claimed,
    MAX(block_timestamp) AS last_at FROM own_claims
    WHERE block_timestamp >= {AS_OF} - 30 GROUP BY 1"""
DRIFT = "((s.mon_price_usd - p.price_30d_avg) / NULLIF(p.price_30d_avg, 0))"
REL["compound"] = f"""SELECT s.validator_id, s.snapshot_date, s.unclaimed_rewards,
    s.unclaimed_rewards_usd, s.mon_price_usd AS current_price, p.price_1d_avg, p.price_7d_avg,
    p.price_30d_avg, p.price_30d_low, p.price_30d_high,
    p.price_volatility_30d,
    {rnd('(s.mon_price_usd - p.price_7d_avg) / NULLIF(p.price_7d_avg, 0) * 100', 2)}
      AS price_change_7d_pct,
    {rnd(DRIFT + ' * 100', 2)} AS price_change_30d_pct,
    COALESCE(c.n, 0) AS claims_last_30d, COALESCE(c.claimed, 0) AS claimed_amount_30d,
    c.last_at AS last_claim_timestamp,
    CAST(date_diff('day', c.last_at, {NOW}) AS INTEGER) AS days_since_last_claim,
    COALESCE(e.earned, 0) AS earnings_30d, COALESCE(e.avg_daily, 0) AS avg_daily_earnings,
    CASE WHEN e.avg_daily > 0 THEN {rnd('s.unclaimed_rewards / e.avg_daily', 1)} END
      AS days_of_earnings_accumulated,
    CASE WHEN {DRIFT} > 0.2 THEN '{SELL}' WHEN {DRIFT} < -0.2 THEN '{COMPOUND}'
      WHEN p.price_volatility_30d > p.price_30d_avg * 0.1 THEN '{PARTIAL}'
      WHEN s.unclaimed_rewards / NULLIF(e.avg_daily, 0) > 30 THEN '{CLAIM}'
      ELSE '{NEUTRAL}' END AS recommendation,
    {key('s.validator_id', 's.snapshot_date')} AS ez_compound_decision_id
    FROM self_snaps s CROSS JOIN trend p
    LEFT JOIN recent_claims c ON c.validator_id = s.validator_id
    LEFT JOIN month_earned e ON e.validator_id = s.validator_id
    WHERE s.snapshot_date = (SELECT MAX(snapshot_date) FROM self_snaps)"""

REL["stake_in"] = """SELECT validator_id, CAST(block_timestamp AS DATE) AS change_date,
    SUM(amount_raw) AS raw_in, COUNT(*) AS n_in FROM delegations GROUP BY 1, 2"""
REL["stake_out"] = """SELECT validator_id, CAST(block_timestamp AS DATE) AS change_date,
    SUM(amount_raw) AS raw_out, COUNT(*) AS n_out FROM undelegations GROUP BY 1, 2"""
REL["both_ways"] = """SELECT COALESCE(i.validator_id, o.validator_id) AS validator_id,
    COALESCE(i.change_date, o.change_date) AS change_date, COALESCE(raw_in, 0) AS raw_in,
    COALESCE(n_in, 0) AS n_in, COALESCE(raw_out, 0) AS raw_out, COALESCE(n_out, 0) AS n_out
    FROM stake_in i FULL JOIN stake_out o ON i.validator_id = o.validator_id
      AND i.change_date = o.change_date"""
REL["net_changes"] = f"""SELECT validator_id, change_date, {tok('raw_in')} AS delegations,
    CAST(raw_in AS DECIMAL(38,0)) AS delegations_raw, n_in AS delegation_count,
    {tok('raw_out')} AS undelegations, CAST(raw_out AS DECIMAL(38,0)) AS undelegations_raw,
    n_out AS undelegation_count, {tok('(raw_in - raw_out)')} AS net_stake_change,
    CAST(raw_in - raw_out AS DECIMAL(38,0)) AS net_stake_change_raw,
    CASE WHEN raw_in > raw_out THEN 'net_inflow' WHEN raw_in < raw_out THEN 'net_outflow'
      ELSE 'neutral' END AS flow_direction,
    {tok('SUM(raw_in - raw_out) OVER (PARTITION BY validator_id ORDER BY change_date ROWS UNBOUNDED PRECEDING)')}
      AS cumulative_net_change,
    {key('validator_id', 'change_date')} AS ez_net_stake_changes_id FROM both_ways"""


def flow(kind: str, rel: str) -> str:
    return f"""SELECT CAST(block_timestamp AS DATE) AS flow_date, validator_id, delegator_address,
      '{kind}' AS flow_type, SUM(amount_raw) AS amount_raw, COUNT(*) AS tx_count
      FROM {rel} GROUP BY ALL"""


REL["flow_rows"] = " UNION ALL ".join(
    flow(k, r) for k, r in [("delegation", "delegations"), ("undelegation", "undelegations"),
                            ("withdrawal", "withdrawals"), ("claim", "claims")])
REL["flows"] = f"""SELECT *, {tok('amount_raw')} AS amount,
    {key('flow_date', 'validator_id', 'delegator_address', 'flow_type')}
      AS ez_staking_flows_daily_id FROM flow_rows"""

REL["settled"] = """SELECT w.validator_id, w.delegator_address, w.block_timestamp,
    w.block_number, COALESCE(u.amount_raw, w.amount_raw) AS settled_raw,
    u.amount_raw AS undelegated_raw
    FROM withdrawals w ASOF LEFT JOIN undelegations u ON u.validator_id = w.validator_id
      AND u.delegator_address = w.delegator_address AND u.withdraw_id = w.withdraw_id
      AND u.block_timestamp < w.block_timestamp"""
REL["actions"] = """SELECT CAST(block_timestamp AS DATE) AS d, validator_id, delegator_address,
      amount_raw AS a, CAST(0 AS DECIMAL(38,0)) AS p FROM delegations
    UNION ALL SELECT CAST(block_timestamp AS DATE), validator_id, delegator_address,
      -amount_raw, amount_raw FROM undelegations
    UNION ALL SELECT CAST(block_timestamp AS DATE), validator_id, delegator_address,
      CAST(0 AS DECIMAL(38,0)), -settled_raw FROM settled"""
REL["day_net"] = """SELECT d, validator_id, delegator_address, SUM(a) AS a, SUM(p) AS p
    FROM actions GROUP BY ALL"""
REL["spine"] = f"""SELECT CAST(x AS DATE) AS d FROM range(DATE '2024-01-01', {AS_OF} + 1,
    INTERVAL 1 DAY) AS r(x)"""
REL["dense"] = """SELECT s.d, q.validator_id, q.delegator_address, COALESCE(n.a, 0) AS a,
    COALESCE(n.p, 0) AS p FROM spine s
    CROSS JOIN (SELECT DISTINCT validator_id, delegator_address FROM actions) q
    LEFT JOIN day_net n ON n.d = s.d AND n.validator_id = q.validator_id
      AND n.delegator_address = q.delegator_address"""
REL["sums"] = """SELECT *, SUM(a) OVER w AS sa, SUM(p) OVER w AS sp FROM dense
    WINDOW w AS (PARTITION BY validator_id, delegator_address ORDER BY d
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def clamp(x: str) -> str:
    return f"CASE WHEN abs({x}) < 100000000000000 THEN 0 ELSE {tok(x)} END"


REL["stake_days"] = f"""SELECT *, active_balance + pending_withdrawal_balance AS total_balance_at_risk,
    {key('balance_date', 'validator_id', 'delegator_address')} AS ez_staking_balances_daily_id
    FROM (SELECT d AS balance_date, validator_id, delegator_address,
      {clamp('sa')} AS active_balance, {clamp('sp')} AS pending_withdrawal_balance,
      {tok('a')} AS daily_active_change, {tok('p')} AS daily_pending_change FROM sums)
    WHERE active_balance <> 0 OR pending_withdrawal_balance <> 0 OR daily_active_change <> 0
      OR daily_pending_change <> 0"""
REL["stake_totals"] = f"""SELECT t.*, mon_price_usd,
    {rnd('total_active_stake * mon_price_usd', 2)} AS total_active_stake_usd,
    {rnd('total_pending_withdrawal * mon_price_usd', 2)} AS total_pending_withdrawal_usd,
    {rnd('total_stake_at_risk * mon_price_usd', 2)} AS total_stake_at_risk_usd,
    {key('balance_date', 'validator_id')} AS ez_validator_totals_daily_id
    FROM (SELECT balance_date, validator_id, {xsum('active_balance')} AS total_active_stake,
      {xsum('pending_withdrawal_balance')} AS total_pending_withdrawal,
      {xsum('active_balance + pending_withdrawal_balance')} AS total_stake_at_risk,
      {xsum('daily_active_change')} AS daily_active_change,
      {xsum('daily_pending_change')} AS daily_pending_change,
      COUNT(DISTINCT delegator_address) AS delegator_count,
      COUNT(DISTINCT CASE WHEN active_balance > 0 THEN delegator_address END)
        AS active_delegator_count FROM stake_days GROUP BY 1, 2) t
    LEFT JOIN closes ON price_date = balance_date"""
REL["self_stake"] = f"""SELECT *,
    CASE WHEN total_active_stake > 0 THEN
      {rnd('self_active_stake / total_active_stake * 100', 4)} ELSE 0 END
      AS self_stake_pct_of_active,
    CASE WHEN total_stake_at_risk > 0 THEN
      {rnd('self_stake_at_risk / total_stake_at_risk * 100', 4)} ELSE 0 END
      AS self_stake_pct_of_total
    FROM (SELECT t.balance_date, t.validator_id, c.auth_address AS validator_address,
      COALESCE(s.active_balance, 0) AS self_active_stake, t.ta AS total_active_stake,
      COALESCE(s.pending_withdrawal_balance, 0) AS self_pending_stake,
      t.tp AS total_pending_stake, COALESCE(s.total_balance_at_risk, 0) AS self_stake_at_risk,
      t.tr AS total_stake_at_risk
      FROM (SELECT balance_date, validator_id, {xsum('active_balance')} AS ta,
        {xsum('pending_withdrawal_balance')} AS tp, {xsum('total_balance_at_risk')} AS tr
        FROM stake_days GROUP BY 1, 2) t
      JOIN created c ON c.validator_id = t.validator_id
      LEFT JOIN stake_days s ON s.balance_date = t.balance_date
        AND s.validator_id = t.validator_id AND s.delegator_address = c.auth_address)"""

REL["wallet_days"] = f"""SELECT day AS d, upper(wallet) AS address, MAX(value) AS balance,
    {raw('MAX(cents)')} AS balance_raw FROM ev
    WHERE event_type = 'view' GROUP BY 1, 2"""
REL["wallet_filled"] = """SELECT s.d AS balance_date, c.validator_id,
    lower(c.auth_address) AS validator_address, w.d IS NULL AS is_forward_filled,
    last_value(w.balance IGNORE NULLS) OVER f AS balance,
    last_value(w.balance_raw IGNORE NULLS) OVER f AS balance_raw
    FROM spine s CROSS JOIN created c
    LEFT JOIN wallet_days w ON lower(w.address) = lower(c.auth_address) AND w.d = s.d
    WINDOW f AS (PARTITION BY c.validator_id ORDER BY s.d
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
REL["wallet_balances"] = f"""SELECT f.*, mon_price_usd,
    {rnd('balance * mon_price_usd', 2)} AS balance_usd,
    {key('balance_date', 'validator_id')} AS ez_validator_balances_daily_id
    FROM wallet_filled f LEFT JOIN closes ON price_date = balance_date
    WHERE balance IS NOT NULL"""


def statement(body: str) -> str:
    """``body`` preceded by the shared relations it needs, in order of use."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_]+", text):
            if word in REL and word not in ordered and re.search(rf"(FROM|JOIN|,)\s+{word}\b", text):
                visit(REL[word])
                if word not in ordered:
                    ordered.append(word)

    visit(body)
    if not ordered:
        return body
    named = ",\n".join(f"{name} AS ({REL[name]})" for name in ordered)
    return f"WITH {named}\n{body}"


def published(rel: str, extra: str = "") -> str:
    """A relation with the validator's name and address added."""
    return statement(
        f"SELECT t.*, v.validator_name, v.consensus_address{extra} FROM {rel} t "
        "LEFT JOIN validators v ON v.validator_id = t.validator_id"
    )
