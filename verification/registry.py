"""Every registered query with the SQL it must equal.

Queries whose result cannot be stated in SQL have none and are covered by tests.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakeflow import operators as ops
from stakeflow.functions import hexwords as hx
from stakeflow.functions.keys import surrogate_key
from stakeflow.functions.numeric import RAW, percent, tokens
from stakeflow.plans import (
    balances, blocks, checks, decisions, earnings, events, refresh, reports, snapshots, validators,
)
from stakeflow.session import shared_dir
from stakeflow.sources import increments, sinks, tables
from stakeflow.sources.samples import AS_OF, SampleChain
from stakeflow.streaming.facts import run_available
from verification import oracle as o

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


@lru_cache(maxsize=16)
def chain(spark: SparkSession, folder: str) -> SampleChain:
    """One set of query plans per session and folder. Plans only: no data is kept."""
    return SampleChain(spark, folder)


def query(name: str, sql: str | None):
    """Register a function of a SampleChain."""

    def register(fn: Callable[[SampleChain], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(chain(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- scans --------------------------------------------------------------------

query("S1_staking_events", o.statement(
    f"SELECT event_name, origin_function_signature, COUNT(*) AS n, MIN(block_timestamp) AS first_at, "
    "MAX(block_timestamp) AS last_at FROM ("
    f"SELECT event_name, '{o.OTHER_SELECTOR}' AS origin_function_signature, ts AS block_timestamp FROM act "
    "UNION ALL SELECT event_name, origin_function_signature, block_timestamp FROM created "
    "UNION ALL SELECT event_name, origin_function_signature, block_timestamp FROM block_rewards "
    "UNION ALL SELECT event_name, origin_function_signature, block_timestamp FROM epoch_changes"
    ") GROUP BY 1, 2"
))(lambda c: tables.staking_events(c.event_logs).groupBy(
    "event_name", "origin_function_signature"
).agg(
    F.count("*").alias("n"), F.min("block_timestamp").alias("first_at"),
    F.max("block_timestamp").alias("last_at"),
))

query("S2_read_table", (
    "SELECT o_orderpriority, COUNT(*) AS n, MIN(o_orderkey) AS low, MAX(o_orderkey) AS high "
    "FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"
))(lambda c: tables.read_table(c.spark, "orders", f"{c.folder}/orders.parquet").filter(
    F.col("o_orderstatus") == "F"
).groupBy("o_orderpriority").agg(
    F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")
))


@query("S3_read_seed", o.statement("SELECT * FROM locations"))
def _seed(c: SampleChain) -> DataFrame:
    path = shared_dir(c.spark, "seed")
    c.seed.write.csv(path, header=True, quote='"', escape='"')
    return tables.read_seed(c.spark, path)


@query("S4_date_spine", (
    "SELECT s.d AS date_day, COUNT(e.event_id) AS n FROM ("
    "SELECT CAST(x AS DATE) AS d FROM range(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY) r(x)"
    ") s LEFT JOIN events e ON CAST(e.ts AS DATE) = s.d GROUP BY 1"
))
def _spine(c: SampleChain) -> DataFrame:
    days = tables.date_spine(c.spark, dt.date(2023, 12, 25), dt.date(2024, 2, 4))
    counts = c.events.groupBy(F.col("day").alias("date_day")).agg(F.count("*").alias("n"))
    return days.join(counts, "date_day", "left").na.fill(0, ["n"])


@query("S5_literal_rows", (
    "SELECT w.weight_name, COUNT(*) AS n FROM events e JOIN (VALUES ('click', 'low'), "
    "('purchase', 'high')) w(event_type, weight_name) ON w.event_type = e.event_type GROUP BY 1"
))
def _literals(c: SampleChain) -> DataFrame:
    rows = tables.literal_rows(
        c.spark, [("click", "low"), ("purchase", "high")], "event_type string, weight_name string"
    )
    return c.table("events").join(rows, "event_type").groupBy("weight_name").agg(
        F.count("*").alias("n")
    )


# --- sinks ----------------------------------------------------------------------

query("K1_register_view", (
    "SELECT user_id % 20 AS vid, COUNT(*) AS n FROM events GROUP BY 1"
))(lambda c: sinks.register_view(
    c.events.select("vid"), "stakeflow_sample_events"
).groupBy("vid").agg(F.count("*").alias("n")))


def _day_totals(c: SampleChain, upto: str, since: str) -> DataFrame:
    return c.events.filter((F.col("day") <= F.lit(upto)) & (F.col("day") >= F.lit(since))).groupBy(
        "day", "vid"
    ).agg(F.count("*").alias("n"))


def _batch(c: SampleChain) -> DataFrame:
    """Days from the 15th on, with other counts and one new column."""
    return _day_totals(c, "9999-12-31", "2024-01-15").select(
        "day", "vid", (F.col("n") * 10).alias("n"), F.lit("batch").alias("origin")
    )


DAY_TOTALS = "SELECT CAST(ts AS DATE) AS day, user_id % 20 AS vid, COUNT(*) AS n FROM events GROUP BY 1, 2"

query("K2_upsert_replace", (
    f"SELECT day, vid, CASE WHEN day >= DATE '2024-01-15' THEN n * 10 ELSE n END AS n, "
    f"CASE WHEN day >= DATE '2024-01-15' THEN 'batch' END AS origin FROM ({DAY_TOTALS})"
))(lambda c: sinks.replace_rows(
    _day_totals(c, "2024-01-20", "0001-01-01"), _batch(c), ["day", "vid"]
))

query("K3_merge_upsert", (
    f"SELECT day, vid, CASE WHEN day >= DATE '2024-01-15' THEN n * 10 ELSE n END AS n, "
    f"CASE WHEN day > DATE '2024-01-20' THEN 'batch' ELSE 'target' END AS origin "
    f"FROM ({DAY_TOTALS})"
))(lambda c: sinks.merge_rows(
    _day_totals(c, "2024-01-20", "0001-01-01").withColumn("origin", F.lit("target")),
    _batch(c), ["day", "vid"], ["n"],
))

query("K4_upsert_pruned", (
    f"SELECT day, vid, n * 10 AS n, 'batch' AS origin FROM ({DAY_TOTALS}) "
    "WHERE day >= DATE '2024-01-15'"
))(lambda c: sinks.pruned_replace_rows(
    _day_totals(c, "2024-01-20", "0001-01-01"), _batch(c), ["day", "vid"], "day"
))


AUDIT = ("inserted_timestamp", "modified_timestamp")
LAST_SEEN = "SELECT user_id, MAX(CAST(ts AS DATE)) AS day, COUNT(*) AS n FROM events"


def _last_seen(c: SampleChain, upto: str) -> DataFrame:
    return c.events.filter(F.col("day") <= F.lit(upto)).groupBy("user_id").agg(
        F.max("day").alias("day"), F.count("*").alias("n")
    )


@query("K2_upsert_writer", f"{LAST_SEEN} GROUP BY 1")
def _moved_keys(c: SampleChain) -> DataFrame:
    """Users by the day they were last seen on: nearly every key moves to another folder."""
    path = shared_dir(c.spark, "last-seen")
    for upto in ("2024-01-20", "9999-12-31"):
        sinks.upsert_replace(c.spark, path, _last_seen(c, upto), "user_id", "day")
    return sinks.read_target(c.spark, path).drop(*AUDIT)


@query("K3_merge_writer", (
    f"SELECT day, vid, CASE WHEN day >= DATE '2024-01-15' THEN n * 10 ELSE n END AS n, "
    f"CASE WHEN day > DATE '2024-01-20' THEN 'batch' ELSE 'target' END AS origin FROM ({DAY_TOTALS})"
))
def _merged(c: SampleChain) -> DataFrame:
    path = shared_dir(c.spark, "merged")
    first = _day_totals(c, "2024-01-20", "0001-01-01").withColumn("origin", F.lit("target"))
    for batch in (first, _batch(c)):
        sinks.merge_upsert(c.spark, path, batch, ["day", "vid"], ["n"])
    return sinks.read_target(c.spark, path).drop(*AUDIT)


@query("K4_pruned_writer", (
    f"SELECT day, vid, CASE WHEN day >= DATE '2024-01-15' THEN n * 10 ELSE n END AS n FROM ({DAY_TOTALS})"
))
def _pruned(c: SampleChain) -> DataFrame:
    path = shared_dir(c.spark, "pruned")
    for batch in (_day_totals(c, "2024-01-20", "0001-01-01"), _batch(c).drop("origin")):
        sinks.upsert_pruned(c.spark, path, batch, ["day", "vid"], "day")
    return sinks.read_target(c.spark, path).drop(*AUDIT)


@query("K5_write_clustered", DAY_TOTALS)
def _clustered(c: SampleChain) -> DataFrame:
    path = shared_dir(c.spark, "clustered")
    sinks.write_clustered(
        _day_totals(c, "9999-12-31", "0001-01-01"), path, partition="day", cluster_by=["vid"]
    )
    return sinks.read_target(c.spark, path)


@query("K6_align_schema", (
    "SELECT user_id % 20 AS vid, COUNT(*) AS n, COUNT(*) FILTER (event_type = 'click') AS clicks, "
    "COUNT(*) FILTER (event_type <> 'click') AS others FROM events GROUP BY 1"
))
def _aligned(c: SampleChain) -> DataFrame:
    clicks = c.events.filter(F.col("event_type") == "click").select("vid", F.lit(1).alias("click"))
    rest = c.events.filter(F.col("event_type") != "click").select("vid", F.lit(1).alias("other"))
    target, batch = sinks.align_schema(clicks, rest)
    return target.unionByName(batch).groupBy("vid").agg(
        F.count("*").alias("n"), F.count("click").alias("clicks"), F.count("other").alias("others")
    )


# --- increments -----------------------------------------------------------------

query("I1_since_watermark", (
    "SELECT user_id % 20 AS vid, COUNT(*) AS n FROM events WHERE ts > ("
    "SELECT MAX(ts) FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20') GROUP BY 1"
))(lambda c: increments.since_watermark(
    c.events, c.events.filter(F.col("day") <= F.lit("2024-01-20")), "ts"
).groupBy("vid").agg(F.count("*").alias("n")))

query("I2_missing_periods", (
    "SELECT CAST(ts AS DATE) AS block_date, MAX(event_id) AS block_number FROM events "
    "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-24' AND DATE '2024-01-30' "
    "AND CAST(ts AS DATE) > DATE '2024-01-25' GROUP BY 1 ORDER BY 1 LIMIT 3"
))(lambda c: increments.missing_periods(
    c.max_blocks, c.max_blocks.filter(F.col("block_date") <= F.lit("2024-01-25")), "block_date", 3,
    earliest=AS_OF - dt.timedelta(days=7), before=AS_OF,
).select("block_date", "block_number"))

query("I3_reprocess_window", (
    "SELECT user_id % 20 AS vid, COUNT(*) AS n FROM events "
    "WHERE CAST(ts AS DATE) > (SELECT CAST(MAX(ts) AS DATE) - 3 FROM events) GROUP BY 1"
))(lambda c: increments.reprocess_window(c.events, c.events, "day", "day", 3).groupBy("vid").agg(
    F.count("*").alias("n")
))

query("I4_since_block", (
    "SELECT '0xm' || CAST((o_orderkey // 700) % 3 AS VARCHAR) AS miner, COUNT(*) AS n FROM orders "
    "WHERE o_orderkey > (SELECT MAX(o_orderkey) FROM orders WHERE o_orderstatus = 'F' "
    "AND o_orderdate < TIMESTAMP '1995-06-01') GROUP BY 1"
))(lambda c: increments.since_block(
    c.blocks, c.table("orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1995-06-01").cast("timestamp_ntz"))
    ).select(F.col("o_orderkey").alias("end_block")),
).groupBy("miner").agg(F.count("*").alias("n")))


# --- event facts ------------------------------------------------------------------

for _id, _name, _rel in [
    ("E1", "validators_created", "created"), ("E2", "delegations", "delegations"),
    ("E3", "undelegations", "undelegations"), ("E4", "withdrawals", "withdrawals"),
    ("E5", "validator_rewards", "rewards"), ("E6", "rewards_claimed", "claims"),
    ("E7", "validator_commission_changes", "commission_changes"),
    ("E8", "validator_status_changes", "status_changes"),
    ("E9", "epoch_changes", "epoch_changes"),
]:
    query(f"{_id}_fact_{_name}", o.statement(f"SELECT * FROM {_rel}"))(
        lambda c, name=_name: c.fact(name)
    )


_EVENT_FACTS = {
    "validators_created": "created", "delegations": "delegations", "undelegations": "undelegations",
    "withdrawals": "withdrawals", "validator_rewards": "rewards", "rewards_claimed": "claims",
    "validator_commission_changes": "commission_changes", "validator_status_changes": "status_changes",
    "epoch_changes": "epoch_changes",
}


@query("E10_facts_one_scan", o.statement(" UNION ALL ".join(
    f"SELECT '{name}' AS fact, {events.FACTS[name][1]} AS fact_id, block_number FROM {rel}" for name, rel in _EVENT_FACTS.items()
)))
def _facts_one_scan(c: SampleChain) -> DataFrame:
    """All nine facts stored by two runs that each scan the logs once."""
    paths = {name: shared_dir(c.spark, f"fact-{name}") for name in _EVENT_FACTS}
    for upto in ("2024-01-15 00:00:00", "9999-12-31 00:00:00"):
        seen = c.event_logs.filter(F.col("modified_timestamp") < F.lit(upto).cast("timestamp_ntz"))
        refresh.refresh_event_facts(c.spark, seen, paths)
    found = [sinks.read_target(c.spark, path).select(F.lit(name).alias("fact"), F.col(events.FACTS[name][1]).alias("fact_id"),
                                                     "block_number") for name, path in paths.items()]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


@query("P1_variant_fields", o.statement(
    f"SELECT event_id, vid AS validator_id, {o.raw('cents')} AS amount_raw, "
    "CAST(NULL AS BIGINT) AS wallet_number FROM act"
))
def _variant(c: SampleChain) -> DataFrame:
    logs = tables.staking_events(c._activity_logs).select(
        F.col("block_number").alias("event_id"), F.parse_json("decoded_log").alias("decoded_log")
    )
    strict = events.with_json_fields(logs, "decoded_log", {
        "validator_id": ("validatorId", "bigint"), "amount_raw": ("amount", RAW),
    })
    return events.with_json_fields(
        strict, "decoded_log", {"wallet_number": ("delegator", "bigint")}, lenient=True
    ).drop("decoded_log")


query("P2_unit_scaling", o.statement(
    f"SELECT event_id, {o.tok(o.raw('cents'))} AS whole, {o.dbl(o.raw('k'))} / 1e16 AS pct FROM ev"
))(lambda c: c.events.select(
    "event_id",
    tokens(F.col("cents").cast("decimal(20,0)") * F.lit(10**16).cast("decimal(17,0)")).alias("whole"),
    percent(F.col("k") * 10**16).alias("pct"),
))

query("P5_surrogate_key", (
    f"SELECT event_id, {o.key('CAST(ts AS DATE)', 'user_id', 'NULL', 'event_type')} AS row_key FROM events"
))(lambda c: c.events.select(
    "event_id", surrogate_key("day", "user_id", F.lit(None), "event_type").alias("row_key")
))


# --- snapshots --------------------------------------------------------------------

def _pending(c: SampleChain) -> DataFrame:
    done = c.max_blocks.filter(F.col("block_date") == F.lit("2024-01-25"))
    days = increments.missing_periods(
        c.max_blocks, done, "block_date", earliest=AS_OF - dt.timedelta(days=7), before=AS_OF
    )
    return snapshots.pending_days(days)


PENDING = (
    "(SELECT CAST(ts AS DATE) AS d, MAX(event_id) AS b FROM events "
    "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-24' AND DATE '2024-01-30' "
    "AND CAST(ts AS DATE) <> DATE '2024-01-25' GROUP BY 1)"
)


def _word(n: str) -> str:
    return f"lpad(lower(to_hex({n})), 64, '0')"


def _body(calldata: str, block: str, call_id: str) -> str:
    return (
        "'{\"method\":\"eth_call\",\"jsonrpc\":\"2.0\",\"params\":[{\"to\":\""
        f"{o.STAKING_CONTRACT}\",\"data\":\"' || {calldata} || '\"}},\"0x' || lower(to_hex({block}))"
        f" || '\"],\"id\":\"' || {call_id} || '\"}}'"
    )


_CALL1 = f"'0x2b6d639a' || {_word('validator_id')}"
query("D1_validator_requests", o.statement(
    "SELECT validator_id, d AS snapshot_date, b AS snapshot_block, "
    f"'0x' || lower(to_hex(b)) AS block_hex, {_CALL1} AS calldata, "
    + _body(_CALL1, "b", "'getValidator-' || CAST(validator_id AS VARCHAR) || '-' || CAST(d AS VARCHAR)")
    + f" AS request FROM created CROSS JOIN {PENDING}"
))(lambda c: snapshots.validator_requests(c.created, _pending(c)))

_CALL2 = f"'0x573c1ce0' || {_word('validator_id')} || lpad(ltrim(auth_address, '0x'), 64, '0')"
query("D2_delegator_requests", o.statement(
    "SELECT validator_id, auth_address, d AS snapshot_date, b AS snapshot_block, "
    f"'0x' || lower(to_hex(b)) AS block_hex, {_CALL2} AS calldata, "
    + _body(_CALL2, "b", "'getDelegator-' || CAST(validator_id AS VARCHAR) || '-' || CAST(d AS VARCHAR)")
    + f" AS request FROM created CROSS JOIN {PENDING}"
))(lambda c: snapshots.delegator_requests(c.created, _pending(c)))

# One validator is not answered on the 26th, nobody on the 28th: both must be asked again, nothing else.
HOLE = "(validator_id = 3 AND snapshot_date = DATE '2024-01-26') OR snapshot_date = DATE '2024-01-28'"
RECENT = (
    "(SELECT CAST(ts AS DATE) AS d, MAX(event_id) AS b FROM events "
    "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-24' AND DATE '2024-01-30' GROUP BY 1)"
)


def _answered(c: SampleChain, purpose: str, store: Callable[[str, str], None]) -> str:
    path = shared_dir(c.spark, purpose)
    store(f"NOT ({HOLE})", path)
    return path


query("D1_pending_pairs", o.statement(
    "SELECT validator_id, d AS snapshot_date, b AS snapshot_block, "
    f"'0x' || lower(to_hex(b)) AS block_hex, {_CALL1} AS calldata, "
    + _body(_CALL1, "b", "'getValidator-' || CAST(validator_id AS VARCHAR) || '-' || CAST(d AS VARCHAR)")
    + f" AS request FROM created CROSS JOIN {RECENT} p WHERE NOT EXISTS (SELECT 1 FROM decoded x "
    f"WHERE x.validator_id = created.validator_id AND x.snapshot_date = p.d AND NOT ({HOLE}))"
))(lambda c: refresh.pending_state_requests(
    c.spark, c.created, c.max_blocks, _answered(c, "answered-states", lambda seen, path: refresh.refresh_validator_states(
        c.spark, c.validator_responses.filter(seen), path)), as_of=AS_OF, back=7,
))

_CALL3 = f"'0xde66a368' || {_word('start_index')}"
query("D3_set_requests", o.statement(
    "SELECT epoch, epoch_start_block, start_index, "
    f"'0x' || lower(to_hex(epoch_start_block)) AS block_hex, {_CALL3} AS calldata, "
    + _body(_CALL3, "epoch_start_block",
            "'getSnapshotValidatorSet-' || CAST(epoch AS VARCHAR) || '-' || CAST(start_index AS VARCHAR)")
    + " AS request FROM epochs CROSS JOIN "
    "(SELECT CAST(x AS BIGINT) AS start_index FROM (VALUES (0), (100), (200)) v(x))"
))(lambda c: snapshots.set_requests(c.epochs))

query("D6_word_numbers", o.statement(
    f"SELECT event_id, {o.wide('cents')} AS whole, CASE WHEN k % 2 = 0 THEN "
    f"{o.wide('k')} END AS half FROM ev"
))(lambda c: c.events.select(
    "event_id",
    hx.to_number(SampleChain._wide(F.col("cents"))).alias("whole"),
    hx.to_number(
        F.when(F.col("k") % 2 == 0, SampleChain._wide(F.col("k"))).otherwise(F.lit("f" * 64))
    ).alias("half"),
))

query("D10_snapshot_get_validator", o.statement("SELECT * FROM decoded"))(lambda c: c.decoded)
query("D11_snapshot_validator_set", o.statement("SELECT * FROM validator_set"))(
    lambda c: c.validator_set
)
query("D12_validator_addresses", o.statement("SELECT * FROM addresses"))(lambda c: c.addresses)


def _in_two_runs(c: SampleChain, purpose: str, late: str, run: Callable) -> DataFrame:
    """A stored table after a run without the rows that ``late`` names and one with them."""
    path = shared_dir(c.spark, purpose)
    for condition in (f"NOT ({late})", "true"):
        run(condition, path)
    return sinks.read_target(c.spark, path).drop(*AUDIT)


# One validator answers a run late on every day, another only on one of them.
LATE = "validator_id = 3 OR (validator_id = 5 AND day(snapshot_date) = 9)"

query("I1b_snapshot_refresh", o.statement("SELECT * FROM vsnaps"))(lambda c: _in_two_runs(
    c, "snapshots", LATE, lambda seen, path: refresh.refresh_snapshots(c.spark, c.validator_snapshots.filter(seen), path)
))
query("D10_validator_states_refresh", o.statement("SELECT * FROM decoded"))(lambda c: _in_two_runs(
    c, "states", LATE, lambda seen, path: refresh.refresh_validator_states(c.spark, c.validator_responses.filter(seen), path)
))
query("M7_delegator_states_refresh", o.statement("SELECT * FROM self_snaps"))(lambda c: _in_two_runs(
    c, "self-states", LATE,
    lambda seen, path: refresh.refresh_delegator_states(c.spark, c.delegator_responses.filter(seen), c.prices, path),
))
query("D11_validator_set_refresh", o.statement("SELECT * FROM validator_set"))(lambda c: _in_two_runs(
    c, "sets", "epoch % 3 = 1 AND start_index = 0",
    lambda seen, path: refresh.refresh_validator_set(c.spark, c.set_responses.filter(seen), path),
))


@query("D12_validator_addresses_refresh", o.statement("SELECT * FROM addresses"))
def _addresses(c: SampleChain) -> DataFrame:
    path = shared_dir(c.spark, "addresses")
    for upto in ("2024-01-10", "9999-12-31"):
        states = c.decoded.filter(F.col("snapshot_date") <= F.lit(upto))
        refresh.refresh_validator_addresses(c.spark, c.created, states, path)
    return sinks.read_target(c.spark, path)


# --- generic operators --------------------------------------------------------------

query("J5_full_outer_measures", (
    "SELECT COALESCE(a.user_id, b.user_id) AS user_id, COALESCE(bought, 0) AS bought, "
    "COALESCE(clicked, 0) AS clicked FROM (SELECT user_id, COUNT(*) AS bought FROM events "
    "WHERE event_type = 'purchase' GROUP BY 1) a FULL JOIN (SELECT user_id, COUNT(*) AS clicked "
    "FROM events WHERE event_type = 'click' GROUP BY 1) b ON a.user_id = b.user_id"
))(lambda c: ops.full_outer_measures(
    c.events.filter(F.col("event_type") == "purchase").groupBy("user_id").agg(F.count("*").alias("bought")),
    c.events.filter(F.col("event_type") == "click").groupBy("user_id").agg(F.count("*").alias("clicked")),
    ["user_id"], ["bought", "clicked"],
))

_DENSE = (
    "SELECT f.user_id, CAST(x AS DATE) AS day, d.total_cents FROM (SELECT user_id, MIN(day) AS d0 FROM day_cents "
    "GROUP BY 1) f, range(f.d0, DATE '2024-02-01', INTERVAL 1 DAY) r(x) "
    "LEFT JOIN day_cents d ON d.user_id = f.user_id AND d.day = CAST(x AS DATE)"
)
_DAY_CENTS = (
    "WITH day_cents AS (SELECT user_id, CAST(ts AS DATE) AS day, "
    "CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents FROM events "
    "WHERE event_type = 'purchase' GROUP BY 1, 2), dense AS (SELECT f.user_id, CAST(r.x AS DATE) AS day "
    "FROM (SELECT user_id, MIN(day) AS d0 FROM day_cents GROUP BY 1) f JOIN (SELECT x FROM "
    "range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY) q(x)) r ON CAST(r.x AS DATE) >= f.d0) "
)


def _day_cents(c: SampleChain) -> DataFrame:
    return c.events.filter(F.col("event_type") == "purchase").groupBy("user_id", "day").agg(
        F.sum("cents").alias("total_cents")
    )


query("J6_densify", _DAY_CENTS + (
    "SELECT s.user_id, s.day, d.total_cents FROM dense s LEFT JOIN day_cents d "
    "ON d.user_id = s.user_id AND d.day = s.day"
))(lambda c: ops.densify(_day_cents(c), ["user_id"], "day", AS_OF))

query("J6_hold_until_next", _DAY_CENTS + (
    "SELECT s.user_id, s.day, last_value(d.total_cents IGNORE NULLS) OVER (PARTITION BY s.user_id "
    "ORDER BY s.day ROWS UNBOUNDED PRECEDING) AS total_cents, d.day IS NULL AS is_repeated "
    "FROM dense s LEFT JOIN day_cents d ON d.user_id = s.user_id AND d.day = s.day"
))(lambda c: ops.hold_until_next(_day_cents(c), ["user_id"], "day", AS_OF))

query("J8_asof_join", (
    "SELECT p.event_id, p.user_id, p.ts, c.event_id AS click_id, c.value AS click_value "
    "FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN "
    "(SELECT * FROM events WHERE event_type = 'click') c ON c.user_id = p.user_id AND c.ts < p.ts"
))(lambda c: ops.asof_join(
    c.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts"),
    c.events.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts", "value"),
    ["user_id"], "ts", "ts", {"click_id": "event_id", "click_value": "value"},
))

# The same scans with spans cut by the data: keys of more than 20 rows are split at sketched quantiles.
query("J8_asof_join_by_depth", ORACLES["J8_asof_join"])(lambda c: ops.asof_join(
    c.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts"),
    c.events.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts", "value"),
    ["user_id"], "ts", "ts", {"click_id": "event_id", "click_value": "value"}, width=ops.Depth(20),
))

query("J8_asof_join_inclusive", (
    "SELECT l.l_partkey, l.l_shipdate, l.n, s.ship_price FROM (SELECT l_partkey, l_shipdate, COUNT(*) AS n "
    "FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) l ASOF LEFT JOIN (SELECT l_partkey, l_shipdate, "
    "MAX(l_extendedprice) AS ship_price FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2) s "
    "ON s.l_partkey = l.l_partkey AND s.l_shipdate <= l.l_shipdate"
))(lambda c: ops.asof_join(
    c.table("lineitem").filter("l_returnflag = 'R'").groupBy("l_partkey", "l_shipdate").agg(F.count("*").alias("n")),
    c.table("lineitem").filter("l_returnflag = 'N'").groupBy("l_partkey", "l_shipdate").agg(F.max("l_extendedprice").alias("p")),
    ["l_partkey"], "l_shipdate", "l_shipdate", {"ship_price": "p"}, strict=False, width=24 * 90,
))

query("J8_matched_withdrawals", o.statement(
    "SELECT validator_id, delegator_address, block_timestamp, settled_raw, undelegated_raw FROM settled"
))(lambda c: balances.matched_withdrawals(c.fact("withdrawals"), c.fact("undelegations")).select(
    "validator_id", "delegator_address", "block_timestamp", "settled_raw", "undelegated_raw"
))

query("W1_latest_per_key", (
    "SELECT user_id, ts, event_id, event_type FROM events QUALIFY "
    "ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"
))(lambda c: ops.latest_per_key(
    c.table("events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], "ts"
))

query("W3_daily_last", o.statement("SELECT price_date, mon_price_usd AS price FROM closes"))(
    lambda c: ops.daily_last(c.prices.filter("is_native"), "hour", "price")
)

query("W2_islands", (
    "WITH b AS (SELECT user_id, event_id, ts, event_type, LAG(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p "
    "FROM events), g AS (SELECT *, SUM(CASE WHEN p IS NULL OR p <> event_type THEN 1 ELSE 0 END) OVER "
    "(PARTITION BY user_id ORDER BY event_id) AS g FROM b), r AS (SELECT user_id, event_type, g, MIN(event_id) AS \"start\", "
    "MAX(event_id) AS \"end\", MIN(ts) AS start_ts, MAX(ts) AS end_ts, COUNT(*) AS n FROM g GROUP BY 1, 2, 3) "
    "SELECT user_id, event_type, \"start\", \"end\", start_ts, end_ts, n, LEAD(event_type) OVER (PARTITION BY user_id ORDER BY g) "
    "AS next_value, LEAD(event_type) OVER (PARTITION BY user_id ORDER BY g) IS NULL AS is_current FROM r"
))(lambda c: ops.islands(
    c.table("events"), "user_id", "event_id", "event_type", "ts", width=1000
))

query("W10_next_values", (
    "SELECT event_id, user_id, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_ts, "
    "LEAD(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS next_type FROM events"
))(lambda c: ops.next_values(
    c.table("events"), ["user_id"], "ts", {"next_ts": "ts", "next_type": "event_type"}
).select("event_id", "user_id", "next_ts", "next_type"))

query("W12_prefix_sums", (
    "SELECT event_id, user_id, CAST(SUM(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id "
    "ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM events"
))(lambda c: ops.prefix_sums(
    c.events.select("event_id", "user_id", "ts", "cents"), ["user_id"], "ts", {"running": "cents"}
).select("event_id", "user_id", "running"))

query("W12_prefix_sums_by_depth", ORACLES["W12_prefix_sums"])(lambda c: ops.prefix_sums(
    c.events.select("event_id", "user_id", "ts", "cents"), ["user_id"], "ts", {"running": "cents"}, width=ops.Depth(20)
).select("event_id", "user_id", "running"))

query("W2_islands_by_depth", ORACLES["W2_islands"])(lambda c: ops.islands(
    c.table("events"), "user_id", "event_id", "event_type", "ts", width=ops.Depth(20)
))

query("W13_running_balance", (
    "SELECT event_id, user_id, CASE WHEN abs(s) < 0.0001 THEN 0 ELSE s END AS balance FROM ("
    "SELECT event_id, user_id, CAST(CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'click' "
    "THEN -1 ELSE 0 END * CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts "
    "ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,0)) * 10000000000000000 AS DOUBLE) / 1e18 AS s FROM events)"
))(lambda c: ops.running_balance(
    c.events.select(
        "event_id", "user_id", "ts",
        (F.when(F.col("event_type") == "purchase", F.col("cents"))
         .when(F.col("event_type") == "click", -F.col("cents")).otherwise(0).cast("decimal(20,0)")
         * F.lit(10**16).cast("decimal(17,0)")).cast(RAW).alias("change"),
    ),
    ["user_id"], "ts", {"balance": "change"},
).select("event_id", "user_id", "balance"))


def _mean_over(n: int) -> str:
    return o.xavg(
        "value", f"OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    )


query("W14_rolling_mean_rows", (
    f"SELECT event_id, user_id, {_mean_over(7)} AS mean_7, {_mean_over(30)} AS mean_30 FROM events"
))(lambda c: ops.rolling_mean_rows(
    c.table("events").select("event_id", "user_id", "ts", "value"), ["user_id"], "ts", "value",
    {"mean_7": 7, "mean_30": 30},
).select("event_id", "user_id", "mean_7", "mean_30"))

query("W15_forward_fill", (
    "SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) "
    "OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS paid, "
    "event_type <> 'purchase' AS is_forward_filled FROM events"
))(lambda c: ops.forward_fill(
    c.table("events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("paid")
    ),
    ["user_id"], "ts", ["paid"],
).select("event_id", "user_id", "paid", "is_forward_filled"))

query("W_weighted_expectation", (
    f"SELECT o_orderkey, o_orderpriority, o_totalprice, t AS group_weight, n AS total_blocks, "
    f"{o.rnd('o_totalprice / NULLIF(t, 0)', 6)} AS weight_share, "
    f"{o.rnd('n * (o_totalprice / NULLIF(t, 0))', 2)} AS expected "
    f"FROM (SELECT o_orderkey, o_orderpriority, o_totalprice, 1000000 AS n FROM orders) JOIN "
    f"(SELECT o_orderpriority AS op, {o.xsum('o_totalprice')} AS t FROM orders GROUP BY 1) ON op = o_orderpriority"
))(lambda c: ops.weighted_expectation(
    c.table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice", F.lit(1_000_000).alias("total_blocks")),
    ["o_orderpriority"], "o_totalprice", "total_blocks",
))

query("L2_latest_price", o.statement("SELECT COUNT(*) AS n, (SELECT p FROM last_price) AS price FROM ev"))(
    lambda c: c.events.agg(F.count("*").alias("n")).withColumn("price", blocks.latest_price(c.prices))
)


# --- published tables -----------------------------------------------------------------

query("M1_dim_epochs", o.statement("SELECT * FROM epochs"))(lambda c: c.epochs)
query("M2_dim_validators", o.statement("SELECT * FROM validators"))(lambda c: c.validators)

MINERS = o.statement(
    "SELECT validator_id, miner, start_block, end_block, start_timestamp, end_timestamp, "
    "blocks_produced, duration_seconds, is_current, next_miner, dim_miner_validators_id FROM miners"
)
query("M3_dim_miner_validators", MINERS)(
    lambda c: blocks.dim_miner_validators(c.rewards, c.blocks)
)


@query("M4_dim_miner_validators_increment", MINERS)
def _miner_increment(c: SampleChain) -> DataFrame:
    """Two thirds of the blocks published; the rest arrive, and one validator's epoch late."""
    number, newest = F.col("block_number"), c.blocks.agg(F.max("block_number")).scalar()
    is_new = (number > newest * 2 / 3) | ((F.col("validator_id") == 3) & (F.col("epoch") == 1))
    published = c.stored(
        blocks.dim_miner_validators(c.rewards.filter(~is_new), c.blocks), "miner-ranges"
    )
    return blocks.dim_miner_validators_increment(
        published, c.rewards.filter(is_new), c.rewards, c.blocks
    )


query("M5_fact_block_priority_fees", o.statement("SELECT * FROM fees"))(lambda c: c.fees)
query("M5_fees_increment", o.statement(
    "SELECT * FROM fees WHERE block_number IN "
    "(SELECT block_number FROM txs WHERE modified_timestamp > TIMESTAMP '2001-11-01 00:00:00')"
))(lambda c: blocks.fact_block_priority_fees_increment(
    c.transactions, c.blocks, c.rewards, dt.datetime(2001, 11, 1)
))
@query("M5_fees_refresh", o.statement("SELECT * FROM fees"))
def _fees_refreshed(c: SampleChain) -> DataFrame:
    """Transactions in two loads, then the rewards of one epoch, which come after their blocks were stored."""
    path = shared_dir(c.spark, "fees")
    early = F.col("epoch") != 1
    stamped = c.rewards.withColumn(
        refresh.MARK, F.when(early, F.lit("2024-01-31")).otherwise(F.lit("2024-02-01")).cast("timestamp_ntz")
    )
    loads = (("2001-11-01", stamped.filter(early)), ("9999-12-31", stamped.filter(early)), ("9999-12-31", stamped))
    for upto, rewards in loads:
        seen = c.transactions.filter(F.col("modified_timestamp") <= F.lit(f"{upto} 00:00:00").cast("timestamp_ntz"))
        refresh.refresh_block_fees(c.spark, seen, c.blocks, rewards, path)
    return sinks.read_target(c.spark, path).drop(*AUDIT, "block_date", refresh.MARK, refresh.REWARD_MARK)


query("M6_fact_validator_snapshots", o.statement("SELECT * FROM vsnaps"))(
    lambda c: c.validator_snapshots
)
query("M7_fact_validator_self_delegation_snapshots", o.statement("SELECT * FROM self_snaps"))(
    lambda c: c.self_snapshots
)
query("M8_ez_block_production", o.published("production", ", v.auth_address"))(
    lambda c: blocks.ez_block_production(c.rewards, c.validators)
)
query("M9_ez_validator_epoch_performance", o.published("performance"))(
    lambda c: c.performance(c.validators)
)
query("M10_ez_miss_rate", o.published("miss_rate"))(
    lambda c: blocks.ez_miss_rate(c.performance(), c.earnings(), c.prices, c.validators)
)
query("M11_ez_restart_impact", o.published("restart"))(
    lambda c: decisions.ez_restart_impact(
        c.performance(), c.epochs, c.earnings(), c.prices, c.validators, as_of=AS_OF
    )
)
query("M12_ez_compound_decision", o.published("compound"))(
    lambda c: c.compound_decision(c.validators)
)
query("M13_ez_net_stake_changes", o.published("net_changes"))(
    lambda c: balances.ez_net_stake_changes(
        c.fact("delegations"), c.fact("undelegations"), c.validators
    )
)
query("M14_ez_staking_flows_daily", o.published("flows"))(
    lambda c: balances.ez_staking_flows_daily(
        c.fact("delegations"), c.fact("undelegations"), c.fact("withdrawals"),
        c.fact("rewards_claimed"), c.validators,
    )
)
query("M15_ez_staking_balances_daily", o.published("stake_days"))(
    lambda c: c.stake_balances(c.validators)
)


@query("M16_ez_staking_balances_increment", o.statement(
    "SELECT * FROM stake_days WHERE balance_date > DATE '2024-01-27'"
))
def _balance_increment(c: SampleChain) -> DataFrame:
    since = dt.date(2024, 1, 27)
    published = c.stored(c.stake_balances(as_of=dt.date(2024, 1, 30), keep_raw=True), "stake-balances")
    return c.stake_balances(previous=published, since=since)


# Facts of day 3 for every fourth validator arrive after the second run, when day 3 is long out of the window.
LATE_FACTS = "day(block_timestamp) = 3 AND validator_id % 4 = 1"
LATE_STAMP = "2024-01-25 00:00:00"


def stamped_facts(c: SampleChain) -> list[DataFrame]:
    """Stored facts with the source mark; the late ones stamped ``LATE_STAMP``.

    They are stored, as the refreshes of a published fact find it: every refresh reads them many times over.
    """
    logs = refresh.with_mark(c.event_logs)
    out = []
    for name in ("delegations", "undelegations", "withdrawals"):
        made = events.fact(logs, name, keep=[refresh.MARK])
        out.append(c.stored(made.withColumn(refresh.MARK, F.when(
            F.expr(LATE_FACTS), F.lit(LATE_STAMP).cast("timestamp_ntz")).otherwise(F.col(refresh.MARK))), f"stamped-{name}"))
    return out


@query("M16_late_refresh", o.statement("SELECT * FROM stake_days"))
def _late_refresh(c: SampleChain) -> DataFrame:
    """Three refreshes; the last one takes in facts older than its window and must equal a rebuild."""
    path = shared_dir(c.spark, "late-balances")
    facts = stamped_facts(c)
    for upto, as_of in (("2024-01-10 23:59:59", dt.date(2024, 1, 10)), ("2024-01-20 23:59:59", dt.date(2024, 1, 20)),
                        ("9999-12-31 00:00:00", AS_OF)):
        seen = [f.filter(F.col(refresh.MARK) <= F.lit(upto).cast("timestamp_ntz")) for f in facts]
        refresh.refresh_stake_balances(c.spark, *seen, path, as_of=as_of)
    return balances.published(sinks.read_target(c.spark, path).drop(*AUDIT))


query("M17_ez_validator_totals_daily", o.published("stake_totals"))(
    lambda c: balances.ez_validator_totals_daily(c.stake_balances(), c.prices, c.validators)
)
query("M18_ez_validator_self_stake", o.published("self_stake"))(
    lambda c: balances.ez_validator_self_stake(c.stake_balances(), c.created, c.validators)
)
query("M19_ez_validator_balances_daily", o.published("wallet_balances"))(
    lambda c: balances.ez_validator_balances_daily(
        c.created, c.native_balances, c.prices, c.validators, as_of=AS_OF
    )
)


@query("M19_ez_validator_balances_increment", o.statement(
    "SELECT * FROM wallet_balances WHERE balance_date >= DATE '2024-01-23'"
))
def _wallet_increment(c: SampleChain) -> DataFrame:
    published = c.stored(balances.ez_validator_balances_daily(
        c.created, c.native_balances, c.prices, as_of=dt.date(2024, 1, 30)
    ), "wallet-balances")
    return balances.ez_validator_balances_daily(
        c.created, c.native_balances, c.prices, as_of=AS_OF, previous=published,
        since=dt.date(2024, 1, 23),
    )


query("M20_ez_validator_earnings", o.published("earnings"))(lambda c: c.earnings(c.validators))
query("M21_ez_validator_apr", o.published("apr"))(
    lambda c: earnings.ez_validator_apr(c.earnings(), c.validator_snapshots, c.validators)
)


# --- reports --------------------------------------------------------------------------

def _period(unit: str) -> str:
    fields = ["claimed_rewards", "unclaimed_change", "priority_fees", "total_earned", "total_earned_usd"]
    sums = ", ".join(f"{o.xsum(f)} AS {f}" for f in fields)
    return o.statement(
        f"SELECT CAST(date_trunc('{unit}', earning_date) AS DATE) AS period, validator_id, {sums}, "
        "CAST(SUM(blocks_produced) AS BIGINT) AS blocks_produced FROM earnings GROUP BY 1, 2"
    )


for _unit in ["day", "week", "month"]:
    query(f"R1_earnings_per_{_unit}", _period(_unit))(
        lambda c, unit=_unit: reports.earnings_per_period(c.earnings(), unit)
    )

query("R2_reward_split", o.statement(
    "SELECT earning_date, validator_id, claimed_rewards + unclaimed_change AS staking_rewards, "
    "priority_fees, total_earned FROM earnings"
))(lambda c: reports.reward_split(c.earnings()))
query("R3_token_totals", o.statement(
    f"SELECT validator_id, {o.xsum('total_earned')} AS total_mon_earned, "
    f"{o.xsum('priority_fees')} AS total_priority_fees, "
    f"{o.xsum('claimed_rewards + unclaimed_change')} AS total_staking_rewards FROM earnings GROUP BY 1"
))(lambda c: reports.token_totals(c.earnings()))
query("R4_gross_revenue", o.statement(
    f"SELECT CAST(date_trunc('month', earning_date) AS DATE) AS month, validator_id, "
    f"{o.xsum('total_earned')} AS gross_revenue_mon, {o.xsum('total_earned_usd')} AS gross_revenue_usd, "
    f"{o.xsum('priority_fees')} AS priority_fee_revenue, "
    f"{o.xsum('claimed_rewards + unclaimed_change')} AS staking_revenue FROM earnings GROUP BY 1, 2"
))(lambda c: reports.gross_revenue(c.earnings()))
query("R5_priority_fees_per_day", o.statement(
    f"SELECT CAST(block_timestamp AS DATE) AS fee_date, validator_id, {o.xsum('total_priority_fee')} "
    "AS priority_fees FROM fees GROUP BY 1, 2"
))(lambda c: reports.priority_fees_per_day(c.fees))
query("R6_classified_transfers", o.statement(
    "SELECT ts AS block_timestamp, wallet AS from_address, '0xd' || CAST(k % 40 AS VARCHAR) AS to_address, "
    "value AS amount, CASE WHEN k % 40 IN (4, 24) THEN 'internal' ELSE 'external' END AS flow_type "
    "FROM ev WHERE event_type = 'purchase' AND user_id IN (4, 24)"
))(lambda c: reports.classified_transfers(c.native_transfers, c.wallet_map, 4))
query("R7_wallets", o.statement(
    "SELECT v.validator_id, v.auth_address, v.consensus_address, '0xd' || CAST(v.validator_id + w.x AS VARCHAR) "
    "AS wallet_address, w.role AS wallet_role FROM validators v CROSS JOIN "
    "(VALUES (0, 'authority'), (20, 'payout')) w(x, role)"
))(lambda c: reports.wallets(c.validators, c.wallet_map))
query("R8_epoch_performance_pct", o.statement(
    "SELECT epoch, validator_id, validator_stake, stake_weight, expected_blocks_per_validator, "
    "actual_blocks_produced, blocks_vs_expected, "
    + o.rnd("actual_blocks_produced / NULLIF(expected_blocks_per_validator, 0) * 100", 2)
    + " AS performance_pct FROM performance"
))(lambda c: reports.epoch_performance_pct(c.performance()))
query("R9_validator_identity", o.statement(
    "SELECT validator_id, validator_name, auth_address AS operator_address, consensus_address, "
    "created_at AS registration_date, initial_commission_pct, current_commission_pct, status FROM validators"
))(lambda c: reports.validator_identity(c.validators))

# Listings: the published table each one reads, and its relation in SQL.
LISTED: dict[str, tuple[Callable[[SampleChain], DataFrame], str]] = {
    "daily_earnings": (lambda c: c.earnings(c.validators), "earnings"),
    "usd_value": (lambda c: c.earnings(), "earnings"),
    "reward_history": (lambda c: c.earnings(), "earnings"),
    "apr": (
        lambda c: earnings.ez_validator_apr(c.earnings(), c.validator_snapshots, c.validators), "apr"
    ),
    "block_production": (
        lambda c: blocks.ez_block_production(c.rewards, c.validators), "production"
    ),
    "block_fees": (lambda c: c.fees, "fees"),
    "epoch_performance": (lambda c: c.performance(c.validators), "performance"),
    "wallet_balances": (
        lambda c: balances.ez_validator_balances_daily(
            c.created, c.native_balances, c.prices, as_of=AS_OF
        ),
        "wallet_balances",
    ),
    "stake_snapshots": (lambda c: c.validator_snapshots, "vsnaps"),
    "flows": (
        lambda c: balances.ez_staking_flows_daily(
            c.fact("delegations"), c.fact("undelegations"), c.fact("withdrawals"),
            c.fact("rewards_claimed"),
        ),
        "flows",
    ),
    "net_stake": (
        lambda c: balances.ez_net_stake_changes(c.fact("delegations"), c.fact("undelegations")),
        "net_changes",
    ),
    "miss_rate": (
        lambda c: blocks.ez_miss_rate(c.performance(), c.earnings(), c.prices), "miss_rate"
    ),
    "restart": (
        lambda c: decisions.ez_restart_impact(
            c.performance(), c.epochs, c.earnings(), c.prices, c.validators, as_of=AS_OF
        ),
        "restart",
    ),
    "compound": (lambda c: c.compound_decision(c.validators), "compound"),
}


def _listing_sql(name: str, rel: str) -> str:
    columns = reports.LISTINGS[name][0]
    named = "validator_name" in columns
    shown = ", ".join(f"v.{c}" if c == "validator_name" else f"t.{c}" for c in columns)
    join = " LEFT JOIN validators v ON v.validator_id = t.validator_id" if named else ""
    return o.statement(f"SELECT {shown} FROM {rel} t{join}")


for _listing, (_frame, _relation) in LISTED.items():
    query(f"R9_{_listing}", _listing_sql(_listing, _relation))(
        lambda c, listing=_listing, frame=_frame: reports.listing(frame(c), listing)
    )


# --- data checks -------------------------------------------------------------------------

query("C1_unique", (
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1"
))(lambda c: checks.unique(c.table("lineitem"), "l_orderkey", "l_linenumber"))
query("C2_not_null", o.statement(
    "SELECT block_number, validator_id FROM fees WHERE validator_id IS NULL"
))(lambda c: checks.not_null(c.fees.select("block_number", "validator_id"), "validator_id"))
query("C3_recent", (
    "SELECT 'ts' AS column_name, MAX(ts) AS latest, MAX(ts) < TIMESTAMP '2024-01-29 00:00:00' AS is_stale FROM events"
))(lambda c: checks.recency(c.table("events"), "ts", AS_OF, days=2))


@query("C4_stored_failures", o.statement(
    "SELECT 'fees' AS table_name, 'not_null' AS check_name, 'validator_id' AS column_name, "
    "COUNT(*) AS failures FROM fees WHERE validator_id IS NULL"
))
def _failures(c: SampleChain) -> DataFrame:
    path = shared_dir(c.spark, "failures")
    checks.store_failures({("fees", "not_null", "validator_id"): checks.not_null(c.fees, "validator_id")}, path)
    return checks.failure_counts(c.spark, path)


# --- streaming -----------------------------------------------------------------------------

@query("T2_stream_delegations", o.statement("SELECT * FROM delegations"))
def _stream(c: SampleChain) -> DataFrame:
    root = shared_dir(c.spark, "stream")
    c.event_logs.write.parquet(f"{root}/logs")
    run_available(c.spark, f"{root}/logs", f"{root}/target", "delegations", f"{root}/checkpoint")
    # The target of a stream is one that the batch refresh goes on with.
    refresh.refresh_event_fact(c.spark, c.event_logs, f"{root}/target", "delegations")
    return sinks.read_target(c.spark, f"{root}/target").drop(
        "inserted_timestamp", "modified_timestamp", "block_date", refresh.MARK
    )


ORDER_CHECKS = dict(
    not_null=["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice"],
    unique=[["o_orderkey"], ["o_custkey", "o_orderdate"]],
    recent={"o_orderdate": 2},
)


def _checks_sql() -> str:
    parts = [
        f"SELECT 'not_null' AS check_name, '{c}' AS column_name, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM orders "
        f"WHERE {c} IS NULL)) AS failures, (SELECT COUNT(*) FROM orders WHERE {c} IS NULL) AS rows_"
        for c in ORDER_CHECKS["not_null"]
    ]
    for cols in ORDER_CHECKS["unique"]:
        k = ", ".join(cols)
        parts.append(
            f"SELECT 'unique', '{','.join(cols)}', COUNT(*), COALESCE(SUM(n), 0) FROM "
            f"(SELECT {k}, COUNT(*) AS n FROM orders GROUP BY {k} HAVING COUNT(*) > 1)"
        )
    for c, days in ORDER_CHECKS["recent"].items():
        parts.append(
            f"SELECT 'recency', '{c}', 1, COUNT(*) FROM orders "
            f"HAVING COUNT(*) > 0 AND COALESCE(MAX({c}) < TIMESTAMP '2001-08-05 00:00:00' - INTERVAL {days} DAY, true)"
        )
    return (
        "SELECT 'orders' AS table_name, check_name, column_name, CAST(failures AS BIGINT) AS failures, "
        "CAST(rows_ AS BIGINT) AS \"rows\" FROM (" + " UNION ALL ".join(parts) + ") WHERE failures > 0"
    )


@query("C5_table_checks", _checks_sql())
def _table_checks(c: SampleChain) -> DataFrame:
    """Eight checks of ``orders`` from one scan, counted per check."""
    found = checks.all_checks(c.table("orders"), "orders", as_of=dt.date(2001, 8, 5), **ORDER_CHECKS)
    return found.groupBy("table_name", "check_name", "column_name").agg(
        F.count("*").alias("failures"), F.sum("n").alias("rows")
    )
