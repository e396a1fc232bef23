"""Contracts, scans, sinks, increments, refresh jobs, streaming, checks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stakeflow.plans import balances, blocks, checks, events, refresh
from stakeflow.session import shared_dir
from stakeflow.sources import increments, sinks, tables
from stakeflow.sources.contracts import CONTRACTS, ContractError, conform
from stakeflow.sources.samples import AS_OF
from stakeflow.streaming.facts import run_available
from tests.conftest import day, rows, same, ts, wei

AUDIT = ["inserted_timestamp", "modified_timestamp"]


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def frame(spark, *items, schema="k int, d date, v int"):
    return spark.createDataFrame(list(items), schema)


def test_contract_names_the_problem(spark):
    good = spark.createDataFrame([(day(1), 5)], "block_date date, block_number int")
    assert dict(conform(good, "max_block_by_date").dtypes)["block_number"] == "bigint"
    with pytest.raises(ContractError, match="missing"):
        conform(good.drop("block_date"), "max_block_by_date")
    with pytest.raises(ContractError, match="instead of"):
        conform(good.withColumn("block_date", F.lit("x")), "max_block_by_date")


def test_filters_and_columns_reach_the_scan(spark, chain, path):
    chain.event_logs.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = events.fact_delegations(tables.read_table(spark, "event_logs", path))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_name,Delegate)" in text and "EqualTo(contract_address," in text
    scan = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "full_decoded_log" not in scan.split("ReadSchema")[1]
    assert "Python" not in text


def test_seed_reads_quotes_and_empty_fields(spark, tmp_path):
    file = tmp_path / "seed.csv"
    file.write_text(
        "validator_id,validator_name,website,image,city,region,country,timezone,latitude,longitude,ip_address\n"
        '3,"Node, ""A""",https://x,,,,Y,UTC,1.5,-2.5,\n'
    )
    r = rows(tables.read_seed(spark, str(file)))[0]
    assert r["validator_name"] == 'Node, "A"' and r["city"] is None and r["ip_address"] is None
    assert r["latitude"] == 1.5 and r["validator_id"] == 3


def test_upsert_rewrites_only_touched_partitions(spark, path, tmp_path):
    first = frame(spark, (1, day(1), 1), (2, day(2), 2), (3, day(2), 3))
    sinks.upsert_replace(spark, path, first, "k", partition="d")
    untouched = {p.name for p in (tmp_path / "table" / "d=2024-01-01").iterdir()}
    batch = frame(spark, (3, day(2), 30, "x"), (4, day(3), 4, None), schema="k int, d date, v int, extra string")
    for _ in range(2):  # a replay changes nothing
        sinks.upsert_replace(spark, path, batch, "k", partition="d")
        out = rows(sinks.read_target(spark, path).drop(*AUDIT), "k")
        assert [(r["k"], r["v"], r["extra"]) for r in out] == [(1, 1, None), (2, 2, None), (3, 30, "x"), (4, 4, None)]
    assert {p.name for p in (tmp_path / "table" / "d=2024-01-01").iterdir()} == untouched
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_merge_keeps_inserted_timestamp(spark, path, tmp_path):
    sinks.merge_upsert(spark, path, frame(spark, (1, day(1), 1), (2, day(1), 2)), ["k"], ["v"])
    before = {r["k"]: r for r in rows(sinks.read_target(spark, path))}
    sinks.merge_upsert(spark, path, frame(spark, (2, day(9), 20), (3, day(9), 3)), ["k"], ["v"])
    after = {r["k"]: r for r in rows(sinks.read_target(spark, path))}
    assert after[1] == before[1]
    assert (after[2]["v"], after[2]["d"]) == (20, day(1))
    assert after[2]["inserted_timestamp"] == before[2]["inserted_timestamp"]
    assert after[2]["modified_timestamp"] > before[2]["modified_timestamp"]
    assert after[3]["d"] == day(9)
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_pruned_upsert_puts_literals_into_the_scan(spark, path):
    sinks.write_clustered(frame(spark, (1, day(1), 1), (2, day(5), 2)), path, partition="d")
    slice_ = sinks.pruned_replace_rows(
        spark.read.parquet(path), frame(spark, (2, day(5), 9), (3, day(6), 3)), ["k"], "d"
    )
    assert sorted((r["k"], r["v"]) for r in rows(slice_)) == [(2, 9), (3, 3)]
    assert "PartitionFilters: [isnotnull(d" in slice_._jdf.queryExecution().executedPlan().toString()


def test_watermarks_and_windows(spark):
    src = frame(spark, (1, day(1), 1), (2, day(5), 2), (3, day(9), 3))
    assert increments.since_watermark(src, None, "k", default=0).count() == 3
    assert increments.since_watermark(src, src.limit(0), "k", default=0).count() == 3
    assert increments.since_watermark(src, src.filter("k < 3"), "k", default=0).count() == 1
    assert increments.reprocess_window(src, src, "d", "d", 4).count() == 1
    assert increments.reprocess_window(src, src, "d", "d", 4, inclusive=True).count() == 2
    assert increments.reprocess_window(src, src.limit(0), "d", "d", 4).count() == 3
    missing = increments.missing_periods(src, src.filter("k = 1"), "d", 1, earliest=day(1), before=day(9))
    assert [r["d"] for r in rows(missing)] == [day(5)]


def test_shared_folder_setting_is_used():
    class Session:
        def __init__(self, folder):
            self.conf = {"spark.checkpoint.dir": folder} if folder else {}
            self.sparkContext = None

    assert shared_dir(Session("hdfs://data/"), "x").startswith("hdfs://data/x-")
    with pytest.raises(ValueError):
        shared_dir(Session(None), "x")
    assert shared_dir(Session("s"), "x") != shared_dir(Session("s"), "x")


def test_event_fact_refresh_in_steps(spark, chain, path):
    logs = chain.event_logs
    for upto in (10, 20, 20, 31):
        seen = logs.filter(F.col("modified_timestamp") < F.lit(f"2024-01-{upto} 12:00:00").cast("timestamp_ntz"))
        refresh.refresh_event_fact(spark, seen, path, "delegations")
    stored = sinks.read_target(spark, path).drop(*AUDIT, refresh.MARK, "block_date")
    same(stored, chain.fact("delegations"))
    assert checks.unique(stored, "fact_delegations_id").count() == 0


def test_fee_refresh_recomputes_whole_blocks(spark, chain, path):
    for upto in ("1999-01-01", "2003-01-01"):
        seen = chain.transactions.filter(F.col("modified_timestamp") < F.lit(upto).cast("timestamp_ntz"))
        refresh.refresh_block_fees(spark, seen, chain.blocks, chain.rewards, path)
    same(sinks.read_target(spark, path).drop(*AUDIT, refresh.MARK, "block_date"), chain.fees)


def test_miner_range_refresh_with_late_rewards(spark, chain, path, tmp_path):
    stamped = chain.rewards.withColumn(
        refresh.MARK,
        F.when((F.col("validator_id") == 3) & (F.col("block_number") % 7 == 0), F.lit("2024-02-02"))
        .when(F.col("block_number") > 900, F.lit("2024-02-01")).otherwise(F.lit("2024-01-31"))
        .cast("timestamp_ntz"),
    )
    for upto in ("2024-01-31", "2024-02-01", "2024-02-02"):
        seen = stamped.filter(F.col(refresh.MARK) <= F.lit(upto).cast("timestamp_ntz"))
        refresh.refresh_miner_ranges(spark, seen, chain.blocks, path)
    same(
        sinks.read_target(spark, path).drop(refresh.MARK),
        blocks.dim_miner_validators(chain.rewards, chain.blocks),
    )


def test_stake_balance_refresh_equals_full(spark, chain, path):
    facts = [chain.fact(n) for n in ("delegations", "undelegations", "withdrawals")]
    for as_of in (day(20), day(22), day(25), AS_OF):
        until = [f.filter(F.to_date("block_timestamp") <= F.lit(as_of)) for f in facts]
        refresh.refresh_stake_balances(spark, *until, path, as_of=as_of)
    full = balances.ez_staking_balances_daily(*facts, as_of=AS_OF)
    same(balances.published(sinks.read_target(spark, path).drop(*AUDIT)), full)
    last = full.filter(F.col("balance_date") == F.lit(AS_OF))
    assert last.filter("daily_active_change <> 0").count() == 0


def test_wallet_balance_refresh_equals_full(spark, chain, path):
    for as_of in (day(5), day(9), day(28), AS_OF):
        native = chain.native_balances.filter(F.col("block_date") <= F.lit(as_of))
        refresh.refresh_wallet_balances(
            spark, chain.created, native, chain.prices, path, as_of=as_of
        )
    full = balances.ez_validator_balances_daily(
        chain.created, chain.native_balances, chain.prices, as_of=AS_OF
    )
    same(sinks.read_target(spark, path).drop(*AUDIT), full)


def test_epoch_and_snapshot_refresh(spark, chain, tmp_path):
    states = str(tmp_path / "states")
    for upto in (day(3), AS_OF):
        refresh.refresh_snapshots(
            spark, chain.validator_snapshots.filter(F.col("snapshot_date") <= F.lit(upto)), states
        )
    stored = sinks.read_target(spark, states)
    same(stored.drop(*AUDIT), chain.validator_snapshots)
    epochs = str(tmp_path / "epochs")
    made = blocks.ez_block_production(chain.rewards)
    for upto in (1, 2):
        refresh.refresh_epoch_performance(
            spark, chain.validator_set.filter(F.col("epoch") <= upto), chain.created, chain.epochs,
            stored, made, epochs, back=1,
        )
    same(sinks.read_target(spark, epochs).drop(*AUDIT), chain.performance())


def test_partitions_without_rows_are_removed(spark, path):
    sinks.replace_partitions(spark, path, frame(spark, (1, day(1), 1), (2, day(2), 2)), "d")
    sinks.replace_partitions(
        spark, path, frame(spark, (3, day(1), 3)), "d", covered=[day(1), day(2)]
    )
    assert [(r["k"], r["d"]) for r in rows(sinks.read_target(spark, path))] == [(3, day(1))]


def test_stream_resumes_and_replays(spark, chain, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("logs", "target", "state"))
    logs = chain.event_logs.withColumn("early", F.col("block_timestamp") < F.lit("2024-01-15").cast("timestamp_ntz"))
    logs.filter("early").drop("early").repartition(3).write.parquet(source)
    run_available(spark, source, target, "withdrawals", state, max_files=2)
    # The second load repeats rows of the first.
    logs.drop("early").write.mode("append").parquet(source)
    run_available(spark, source, target, "withdrawals", state)
    same(spark.read.parquet(target).drop(*AUDIT, "block_date", refresh.MARK), chain.fact("withdrawals"))


def test_checks_return_failing_rows(spark, path):
    df = frame(spark, (1, day(1), 1), (1, day(2), None), (2, day(3), 3))
    assert [(r["k"], r["n"]) for r in rows(checks.unique(df, "k"))] == [(1, 2)]
    assert checks.not_null(df, "v").count() == 1
    assert checks.recent(df, "d", day(5)).count() == 0
    assert checks.recent(df, "d", day(6)).count() == 1
    assert checks.recent(df.limit(0), "d", day(6)).count() == 1
    checks.store_failures({
        ("t", "unique", "k"): checks.unique(df, "k"), ("t", "not_null", "v"): checks.not_null(df, "v"),
    }, path)
    found = rows(checks.failure_counts(spark, path), "check_name")
    assert [(r["check_name"], r["failures"]) for r in found] == [("not_null", 1), ("unique", 1)]


def test_periods_are_counted_not_rows(spark):
    src = frame(spark, (1, day(1), 1), (2, day(2), 2), (3, day(2), 3), (4, day(3), 4), (5, day(4), 5))
    assert [r["k"] for r in rows(increments.missing_periods(src, src.filter("k = 1"), "d", 2), "k")] == [2, 3, 4]
    assert increments.missing_periods(src, None, "d").count() == 5


def test_moved_key_leaves_its_old_partition(spark, path):
    sinks.upsert_replace(spark, path, frame(spark, (1, day(1), 1), (2, day(2), 2), (3, day(2), 3)), "k", "d")
    sinks.upsert_replace(spark, path, frame(spark, (1, day(3), 9), (2, day(3), 9)), "k", "d")
    found = rows(sinks.read_target(spark, path).drop(*AUDIT), "k")
    assert [(r["k"], r["d"], r["v"]) for r in found] == [(1, day(3), 9), (2, day(3), 9), (3, day(2), 3)]


def test_late_snapshot_rows_are_taken(spark, chain, path):
    late = F.col("validator_id") == 2
    for seen in (chain.validator_snapshots.filter(~late), chain.validator_snapshots):
        refresh.refresh_snapshots(spark, seen, path)
    same(sinks.read_target(spark, path).drop(*AUDIT), chain.validator_snapshots)


def test_stake_refresh_keeps_amounts_below_the_clamp(spark, path):
    """Two deposits too small to show make one that does; a large balance keeps its last digits."""
    make = lambda *found: spark.createDataFrame(
        [(v, f"0x{v}", ts(f"{d:02d} 10:00:00"), wei(a)) for v, d, a in found],
        "validator_id long, delegator_address string, block_timestamp timestamp_ntz, amount_raw decimal(38,0)",
    )
    none = spark.createDataFrame([], (
        "validator_id long, delegator_address string, withdraw_id long, block_timestamp timestamp_ntz, "
        "amount_raw decimal(38,0), block_number long, event_index int"
    ))
    deposits = make((1, 1, "0.00006"), (1, 8, "0.00006"), (2, 1, "12345678901.123457"), (2, 8, "0.000002"))
    for as_of in (day(3), day(7), day(12)):
        seen = deposits.filter(F.to_date("block_timestamp") <= F.lit(as_of))
        refresh.refresh_stake_balances(spark, seen, none, none, path, as_of=as_of)
    stored = balances.published(sinks.read_target(spark, path).drop(*AUDIT))
    full = balances.ez_staking_balances_daily(deposits, none, none, as_of=day(12))
    same(stored, full)
    last = {r["validator_id"]: r["active_balance"] for r in rows(full.filter(F.col("balance_date") == F.lit(day(12))))}
    assert last[1] == 0.00012


def test_set_pages_go_on_until_done(spark):
    from stakeflow.plans import snapshots

    def page(epoch, start, done, after):
        word = lambda n: f"{n:064x}"
        body = "0x" + word(done) + word(after) + word(96) + word(1) + word(start)
        return (epoch, epoch * 10, start, '{"data":{"result":"' + body + '"}}')

    answers = spark.createDataFrame(
        [page(1, 0, 0, 100), page(1, 100, 0, 200), page(1, 200, 0, 300), page(2, 0, 1, 100)],
        "epoch long, epoch_start_block long, start_index long, response string",
    )
    asked = rows(snapshots.next_set_requests(answers))
    assert [(r["epoch"], r["start_index"]) for r in asked] == [(1, 300)]
    full = answers.unionByName(spark.createDataFrame([page(1, 300, 1, 320)], answers.schema))
    assert snapshots.next_set_requests(full).count() == 0


def test_every_pending_day_is_requested(spark, chain):
    from stakeflow.plans import snapshots

    days = snapshots.pending_days(chain.max_blocks)
    assert snapshots.validator_requests(chain.created, days).count() == days.count() * chain.created.count()


def test_late_events_beyond_the_window_equal_a_rebuild(spark, chain, path):
    """Facts of day 3 arrive after the refresh of day 20 (window: days after 17)."""
    import os

    from verification.registry import LATE_FACTS, stamped_facts

    facts = stamped_facts(chain)
    assert sum(f.filter(LATE_FACTS).count() for f in facts) > 0
    runs = (("2024-01-10 23:59:59", day(10)), ("2024-01-20 23:59:59", day(20)), ("9999-12-31 00:00:00", AS_OF))

    def seen(upto):
        return [f.filter(F.col(refresh.MARK) <= F.lit(upto).cast("timestamp_ntz")) for f in facts]

    def files(folder, d):
        return sorted(os.listdir(os.path.join(folder, f"balance_date={d.isoformat()}")))

    for upto, as_of in runs[:2]:
        refresh.refresh_stake_balances(spark, *seen(upto), path, as_of=as_of)
    before = {d: files(path, d) for d in (day(1), day(2))}
    refresh.refresh_stake_balances(spark, *seen(runs[2][0]), path, as_of=AS_OF)
    full = balances.ez_staking_balances_daily(*facts, as_of=AS_OF)
    same(balances.published(sinks.read_target(spark, path).drop(*AUDIT)), full)
    # Days before the earliest late day keep their files.
    assert {d: files(path, d) for d in before} == before
    # Without marks the late facts are not noticed, and the stored table is wrong.
    other = path + "-unmarked"
    for upto, as_of in runs:
        given = [f.drop(refresh.MARK) if upto.startswith("9999") else f for f in seen(upto)]
        refresh.refresh_stake_balances(spark, *given, other, as_of=as_of)
    stale = balances.published(sinks.read_target(spark, other).drop(*AUDIT))
    assert stale.exceptAll(full.select(*stale.columns)).count() > 0


def test_late_refresh_reads_stored_facts_and_finds_late_pairs_once(spark, chain, path, monkeypatch):
    from verification.registry import stamped_facts

    facts = stamped_facts(chain)
    assert not any("events.parquet" in file for f in facts for file in f.inputFiles())
    read = []
    real = refresh.replace_partitions
    monkeypatch.setattr(refresh, "replace_partitions", lambda s, p, df, *a, **k: (read.append(df.inputFiles()), real(s, p, df, *a, **k)))
    for upto, as_of in (("2024-01-20 23:59:59", day(20)), ("9999-12-31 00:00:00", AS_OF)):
        seen = [f.filter(F.col(refresh.MARK) <= F.lit(upto).cast("timestamp_ntz")) for f in facts]
        refresh.refresh_stake_balances(spark, *seen, path, as_of=as_of)
    assert [any("late-pairs-" in file for file in files) for files in read] == [False, True]
    same(balances.published(sinks.read_target(spark, path).drop(*AUDIT)), balances.ez_staking_balances_daily(*facts, as_of=AS_OF))


def test_unanswered_calls_are_asked_again(spark, chain, tmp_path):
    """Day 26 answered for all validators but 3, day 28 for none: exactly those calls are pending."""
    from verification.registry import HOLE

    for kind, store, pending, responses in (
        ("states", lambda r, p: refresh.refresh_validator_states(spark, r, p), refresh.pending_state_requests,
         chain.validator_responses),
        ("self", lambda r, p: refresh.refresh_delegator_states(spark, r, chain.prices, p), refresh.pending_delegator_requests,
         chain.delegator_responses),
    ):
        target = str(tmp_path / kind)
        store(responses.filter(f"NOT ({HOLE})"), target)
        asked = {(r["validator_id"], r["snapshot_date"]) for r in
                 pending(spark, chain.created, chain.max_blocks, target, as_of=AS_OF, back=7).collect()}
        never = {(r["validator_id"], r["snapshot_date"]) for r in
                 pending(spark, chain.created, chain.max_blocks, str(tmp_path / f"{kind}-none"), as_of=AS_OF, back=7).collect()}
        held = {(r["validator_id"], r["snapshot_date"]) for r in sinks.read_target(spark, target).collect()}
        held_all = {(r["validator_id"], r["snapshot_date"]) for r in
                    (snapshots_of(spark, responses, kind, chain)).collect()}
        missing = {k for k in held_all if k[1] == day(28) or k == (3, day(26))}
        assert missing and missing <= asked
        assert not asked & held
        assert asked == never - held
        # Once the missing answers arrive, only calls that never get an answer stay pending.
        store(responses, target)
        again = {(r["validator_id"], r["snapshot_date"]) for r in
                 pending(spark, chain.created, chain.max_blocks, target, as_of=AS_OF, back=7).collect()}
        assert again == never - held_all and not again & missing


def snapshots_of(spark, responses, kind, chain):
    from stakeflow.plans import snapshots

    if kind == "states":
        return snapshots.snapshot_get_validator(responses)
    return snapshots.fact_validator_self_delegation_snapshots(responses, chain.prices)


def test_merge_rewrites_only_files_with_a_key_of_the_batch(spark, path, tmp_path):
    import os

    first = spark.createDataFrame([(k, day(1 + k % 3), k) for k in range(300)], "k int, d date, v int")
    sinks.merge_upsert(spark, path, first.repartition(6, "k"), ["k"], ["v"])
    files = lambda: sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    before = files()
    holder = {r["k"]: r["f"] for r in sinks.read_target(spark, path).select("k", F.col("_metadata.file_path").alias("f")).collect()}
    batch = spark.createDataFrame([(7, day(9), 70), (1000, day(9), 1)], "k int, d date, v int")
    sinks.merge_upsert(spark, path, batch, ["k"], ["v"])
    after = files()
    gone = {os.path.basename(holder[7].replace("file:", ""))}
    assert set(before) - set(after) == gone
    assert len(set(after) - set(before)) >= 1
    found = {r["k"]: (r["d"], r["v"]) for r in sinks.read_target(spark, path).collect()}
    assert len(found) == 301 and found[7] == (day(2), 70) and found[1000] == (day(9), 1) and found[8] == (day(3), 8)
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_all_checks_of_a_table_in_one_scan(spark, tmp_path):
    table = str(tmp_path / "orders")
    df = spark.createDataFrame(
        [(1, 10, day(1), "a"), (1, 11, day(2), None), (2, None, day(2), "b"), (3, 11, day(2), "c"), (4, 12, None, "d")],
        "k long, c long, d date, s string",
    )
    df.write.parquet(table)
    stored = spark.read.parquet(table)
    found = checks.all_checks(
        stored, "t", not_null=["k", "c", "d", "s"], unique=[["k"], ["c", "d"], ["s"]], recent={"d": 2}, as_of=day(9),
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    got = {(r["check_name"], r["column_name"], r["n"]) for r in found.collect()}
    assert got == {
        ("not_null", "c", 1), ("not_null", "d", 1), ("not_null", "s", 1),
        ("unique", "k", 2), ("unique", "c,d", 2), ("recency", "d", 5),
    }
    assert checks.unique(stored, "k").count() == 1 and checks.not_null(stored, "c").count() == 1
    fresh = checks.all_checks(stored, "t", recent={"d": 10}, as_of=day(9))
    assert fresh.count() == 0


def test_nine_facts_from_one_scan_and_one_stream(spark, chain, tmp_path, monkeypatch):
    from stakeflow.streaming.facts import log_stream, start_facts

    source = str(tmp_path / "logs")
    chain.event_logs.write.parquet(source)
    logs = spark.read.parquet(source)
    staged = []
    real = refresh.staking_events
    monkeypatch.setattr(refresh, "staking_events", lambda df: staged.append(real(df)) or staged[-1])
    paths = {name: str(tmp_path / name) for name in events.FACTS}
    for upto in ("2024-01-15 00:00:00", "9999-12-31 00:00:00"):
        refresh.refresh_event_facts(spark, logs.filter(F.col("modified_timestamp") < F.lit(upto).cast("timestamp_ntz")), paths)
    assert len(staged) == 2
    assert all(df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1 for df in staged)
    streamed = {name: str(tmp_path / f"s-{name}") for name in ("delegations", "withdrawals", "epoch_changes")}
    start_facts(log_stream(spark, source), streamed, str(tmp_path / "state")).awaitTermination()
    for name in events.FACTS:
        same(sinks.read_target(spark, paths[name]).drop(*AUDIT, refresh.MARK, "block_date"), chain.fact(name))
    for name, path in streamed.items():
        same(spark.read.parquet(path).drop(*AUDIT, refresh.MARK, "block_date"), chain.fact(name))


def test_rare_event_does_not_reload_the_others(spark, tmp_path, monkeypatch):
    """The only epoch change is on day 1; a later run stages the delegations that are new, not those of days 2 and 3."""
    body = '{"validatorId":1,"delegator":"0xd","amount":"5","activationEpoch":1,"oldEpoch":0,"newEpoch":1}'
    made = [(1, 1, "EpochChanged"), *[(d + 1, d, "Delegate") for d in range(1, 6)]]
    logs = conform(spark.createDataFrame(
        [(n, ts(f"{d:02d} 10:00:00"), f"0x{n}", 0, tables.STAKING_CONTRACT, name, body, body, "0xa", "0xb", "0xc", True, f"{n}",
          ts(f"{d:02d} 10:00:00"), ts(f"{d:02d} 10:00:00")) for n, d, name in made], CONTRACTS["event_logs"],
    ), "event_logs")
    staged = []
    real = refresh.fan_out_facts
    monkeypatch.setattr(refresh, "fan_out_facts", lambda s, df, p: (staged.append({r["block_number"] for r in df.collect()}), real(s, df, p)))
    paths = {name: str(tmp_path / name) for name in ("delegations", "epoch_changes")}
    for upto in (day(3), day(5)):
        refresh.refresh_event_facts(spark, logs.filter(F.to_date("modified_timestamp") <= F.lit(upto)), paths)
    assert staged == [{1, 2, 3, 4}, {5, 6}]
    for name, path in paths.items():
        same(sinks.read_target(spark, path).drop(*AUDIT, refresh.MARK, "block_date"), events.fact(logs, name))


def test_first_load_and_refilled_partitions_are_evaluated_once(spark, path, monkeypatch):
    """A first load is written where it belongs; days that the batch fills itself are not looked through for leftovers."""
    asked = []
    real = sinks._values
    monkeypatch.setattr(sinks, "_values", lambda df, c: asked.append(df.inputFiles()) or real(df, c))
    written = []
    swap = sinks.swap_in
    monkeypatch.setattr(sinks, "swap_in", lambda df, *a: (written.extend(df.inputFiles()), swap(df, *a)))
    sinks.upsert_replace(spark, path, frame(spark, (1, day(1), 1), (2, day(2), 2)), "k", "d")
    assert not written
    sinks.upsert_replace(spark, path, frame(spark, (2, day(2), 9), (3, day(3), 9)), "k", "d")
    assert len(asked) == 2  # the days of the batch, and those that hold its keys
    found = rows(sinks.read_target(spark, path).drop(*AUDIT), "k")
    assert [(r["k"], r["d"], r["v"]) for r in found] == [(1, day(1), 1), (2, day(2), 9), (3, day(3), 9)]


def test_fee_increment_reads_the_days_of_touched_blocks(spark, chain):
    txs = chain.transactions
    newest = txs.agg(F.max("block_timestamp")).first()[0]
    oldest = txs.agg(F.min("block_number")).first()[0]
    late = txs.withColumn("modified_timestamp", F.when(
        (F.col("block_number") == oldest) | (F.to_date("block_timestamp") == F.lit(newest.date())),
        F.lit("2100-01-01").cast("timestamp_ntz")).otherwise(F.col("modified_timestamp")))
    found = blocks.fact_block_priority_fees_increment(late, chain.blocks, chain.rewards, dt.datetime(2099, 1, 1))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    days = {r[0] for r in late.filter("modified_timestamp > '2099-01-01'").select(F.to_date("block_timestamp")).distinct().collect()}
    assert len(days) == 2 and all(d.isoformat() in plan for d in days)
    touched = late.filter("modified_timestamp > '2099-01-01'").select("block_number").distinct()
    same(found, chain.fees.join(touched, "block_number", "left_semi"))
