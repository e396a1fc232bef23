"""Chain-shaped inputs derived from the star-schema sample tables.

Every input is computed by Spark from whole tables, so work grows with them:
``events`` gives contract events, prices, wallet balances and state responses;
``orders`` gives blocks, producer rewards and epochs; ``lineitem`` transactions;
``supplier`` labels; ``customer`` the location seed.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stakeflow.functions.hexwords import address_word, int_word
from stakeflow.functions.numeric import RAW
from stakeflow.plans import balances, blocks, decisions, earnings, events, snapshots, validators
from stakeflow.session import shared_dir, tune
from stakeflow.sources.contracts import conform
from stakeflow.sources.tables import REWARD_SELECTOR, STAKING_CONTRACT

AS_OF = dt.date(2024, 1, 31)
VALIDATORS = 20
BLOCKS_PER_EPOCH = 500
SECONDS_PER_BLOCK = 173
CYCLE_SECONDS = 30 * 86400
SET_PAGE = 10
OTHER_CONTRACT = "0x0000000000000000000000000000000000002000"
OTHER_SELECTOR = "0x84994fec"
CENT = 10**16
# State words hold cents shifted left by 56 bits: wider than 64 bits, easy to write in hex.
SHIFT_HEX = "0" * 14

# Compressed public keys of the private keys 1 to 10.
SAMPLE_KEYS = [
    "0279be667ef9dcbbac55a06295ce870b07029bfcdb2dce28d959f2815b16f81798",
    "02c6047f9441ed7d6d3045406e95c07cd85c778e4b8cef3ca7abac09b95c709ee5",
    "02f9308a019258c31049344f85f89d5229b531c845836f99b08601f113bce036f9",
    "02e493dbf1c10d80f3581e4904930b1404cc6c13900ee0758474fa94abe8c4cd13",
    "022f8bde4d1a07209355b4a7250a5c5128e88b84bddc619ab7cba8d569b240efe4",
    "03fff97bd5755eeea420453a14355235d382f6472f8568a18b2f057a1460297556",
    "025cbdf0646e5db4eaa398f365f2ea7a0e3d419b7e0330e39ce92bddedcac4f9bc",
    "022f01e5e15cca351daff3843fb70f3c2f0a1bdd05e5af888a67784ef3e10a2a01",
    "03acd484e2f0c7f65309ad178a9f559abde09796974c57e714c35f110dfc27ccbe",
    "03a0434d9e47f3c86235477c7b1ae6ae5d3442d49b1943c2b752a68e2a47e247c7",
]
# Their account addresses, as published with the curve's test keys.
SAMPLE_ADDRESSES = [
    "0x7e5f4552091a69125d5dfcb7b8c2659029395bdf",
    "0x2b5ad5c4795c026514f8317c7a215e218dccd6cf",
    "0x6813eb9362372eef6200f3b1dbc3f819671cba69",
    "0x1eff47bc3a10a45d4b230b5d10e37751fe6aa718",
    "0xe1ab8145f7e55dc933d51a18c793f901a3a0b276",
    "0xe57bfe9f44b819898f47bf37e5af72a0783e1141",
    "0xd41c057fd1c78805aac12b0a94a405c0461a6fbb",
    "0xf1f6619b38a98d6de0800f1defc0a6399eb6d30c",
    "0xf7edc8fa1ecc32967f827c9043fcae6ba73afa5c",
    "0x4cceba2d7d2b4fdce4304d3e09a1fea9fbeb1528",
]


def pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _block_time(number: Column) -> Column:
    seconds = (number * SECONDS_PER_BLOCK) % CYCLE_SECONDS
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


class SampleChain:
    """Inputs, facts and published tables over one folder of sample tables.

    Everything is lazy: a chain holds query plans, never data.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._facts: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def stored(self, df: DataFrame, purpose: str) -> DataFrame:
        """``df`` written to the shared folder and read back, as a published table is."""
        path = shared_dir(self.spark, purpose)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    # --- inputs --------------------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        """events with the derived columns the rules below share."""
        return self.table("events").select(
            "event_id", "ts", "user_id", "event_type", "value",
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            F.round(F.col("value") * 100).cast("bigint").alias("cents"),
            F.to_date("ts").alias("day"),
            (F.col("user_id") % VALIDATORS).alias("vid"),
            F.concat(F.lit("0xd"), F.col("user_id").cast("string")).alias("wallet"),
        )

    @cached_property
    def event_logs(self) -> DataFrame:
        parts = [self._activity_logs, self._creation_logs, self._reward_logs, self._epoch_logs]
        logs = parts[0]
        for part in parts[1:]:
            logs = logs.unionByName(part)
        return conform(logs, "event_logs")

    def _log(self, df: DataFrame, number: str, time: Column, hash_text: Column, name: Column,
             body: Column, contract: Column, ok: Column, selector: Column) -> DataFrame:
        return df.select(
            F.col(number).alias("block_number"), time.alias("block_timestamp"),
            F.concat(F.lit("0x"), F.md5(hash_text)).alias("tx_hash"),
            F.lit(0).alias("event_index"), contract.alias("contract_address"),
            name.alias("event_name"), body.alias("decoded_log"), body.alias("full_decoded_log"),
            F.lit("0xorigin").alias("origin_from_address"),
            F.lit(STAKING_CONTRACT).alias("origin_to_address"),
            selector.alias("origin_function_signature"), ok.alias("tx_succeeded"),
            F.md5(hash_text).alias("event_log_id"), time.alias("inserted_timestamp"),
            time.alias("modified_timestamp"),
        )

    @cached_property
    def _activity_logs(self) -> DataFrame:
        k, kind = F.col("k"), F.col("event_type")
        name = (
            F.when(kind == "purchase", "Delegate").when(kind == "click", "Undelegate")
            .when(kind == "view", "Withdraw").when(kind == "signup", "ClaimRewards")
            .when(k < 10, "CommissionChanged").when(k < 20, "ValidatorStatusChanged")
            .otherwise("ValidatorRewarded")
        )
        epoch = F.dayofmonth("day")
        # Amounts are quoted, as 256-bit integers are in decoded logs.
        amount = (F.col("cents").cast("decimal(20,0)") * F.lit(CENT).cast("decimal(17,0)")).cast(RAW)
        body = F.to_json(F.struct(
            F.col("vid").alias("validatorId"), F.col("wallet").alias("delegator"),
            F.col("wallet").alias("from"), amount.cast("string").alias("amount"),
            (k % 4).alias("withdrawId"), epoch.alias("activationEpoch"),
            epoch.alias("withdrawEpoch"), epoch.alias("epoch"), (k % 2).alias("flags"),
            (k * CENT).cast("string").alias("oldCommission"),
            ((k + 1) * CENT).cast("string").alias("newCommission"),
        ))
        ident = F.col("event_id")
        return self._log(
            self.events, "event_id", F.col("ts"), ident.cast("string"), name, body,
            F.when(ident % 53 == 0, OTHER_CONTRACT).otherwise(STAKING_CONTRACT),
            ident % 50 != 0, F.lit(OTHER_SELECTOR),
        )

    @cached_property
    def _creation_logs(self) -> DataFrame:
        firsts = self.events.groupBy("vid").agg(F.min("event_id").alias("n"), F.min("ts").alias("t"))
        body = F.to_json(F.struct(
            F.col("vid").alias("validatorId"),
            F.concat(F.lit("0xd"), F.col("vid").cast("string")).alias("authAddress"),
            ((F.col("vid") + 1) * CENT).cast("string").alias("commission"),
        ))
        return self._log(
            firsts, "n", F.col("t"), F.concat(F.lit("created-"), F.col("vid").cast("string")),
            F.lit("ValidatorCreated"), body, F.lit(STAKING_CONTRACT), F.lit(True),
            F.lit(OTHER_SELECTOR),
        )

    @cached_property
    def _reward_logs(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
        cents = F.round(F.col("o_totalprice") * 100).cast("decimal(20,0)")
        number = F.col("o_orderkey")
        body = F.to_json(F.struct(
            (F.col("o_custkey") % VALIDATORS).alias("validatorId"),
            F.lit(STAKING_CONTRACT).alias("from"),
            (cents * F.lit(CENT).cast("decimal(17,0)")).cast(RAW).cast("string").alias("amount"),
            F.floor(number / BLOCKS_PER_EPOCH).alias("epoch"),
        ))
        return self._log(
            orders, "o_orderkey", _block_time(number),
            F.concat(F.lit("block-"), number.cast("string")), F.lit("ValidatorRewarded"), body,
            F.lit(STAKING_CONTRACT), F.lit(True),
            F.when(number % 10 == 9, OTHER_SELECTOR).otherwise(REWARD_SELECTOR),
        )

    @cached_property
    def _first_blocks(self) -> DataFrame:
        """The first block of each epoch, whichever it is."""
        return self.table("orders").groupBy(F.floor(F.col("o_orderkey") / BLOCKS_PER_EPOCH).alias("_epoch")).agg(
            F.min("o_orderkey").alias("o_orderkey")
        ).drop("_epoch")

    @cached_property
    def _epoch_logs(self) -> DataFrame:
        number = F.col("o_orderkey")
        firsts = self._first_blocks
        epoch = F.floor(number / BLOCKS_PER_EPOCH)
        body = F.to_json(F.struct((epoch - 1).alias("oldEpoch"), epoch.alias("newEpoch")))
        return self._log(
            firsts, "o_orderkey", _block_time(number),
            F.concat(F.lit("epoch-"), epoch.cast("string")), F.lit("EpochChanged"), body,
            F.lit(STAKING_CONTRACT), F.lit(True), F.lit(OTHER_SELECTOR),
        )

    @cached_property
    def blocks(self) -> DataFrame:
        number = F.col("o_orderkey")
        df = self.table("orders").select(
            number.alias("block_number"),
            F.concat(F.lit("0xm"), (F.floor(number / 700) % 3).cast("string")).alias("miner"),
            ((number % 50) * 1_000_000_000).cast(RAW).alias("base_fee_per_gas"),
        )
        return conform(df, "blocks")

    @cached_property
    def transactions(self) -> DataFrame:
        number = F.col("l_orderkey")
        df = self.table("lineitem").select(
            number.alias("block_number"), _block_time(number).alias("block_timestamp"),
            F.concat(F.lit("0x"), F.md5(F.concat_ws(
                "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
            ))).alias("tx_hash"),
            F.col("l_quantity").cast("bigint").alias("gas_used"),
            (F.col("l_extendedprice") / 1000).alias("effective_gas_price"),
            F.col("l_shipdate").alias("modified_timestamp"),
        )
        return conform(df, "transactions")

    @cached_property
    def prices(self) -> DataFrame:
        hours = self.events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
            F.max("value").alias("_p")
        )
        quotes = F.explode(F.array(
            F.struct(F.col("_p").alias("price"), F.lit(True).alias("is_native")),
            F.struct((F.col("_p") + 1000).alias("price"), F.lit(False).alias("is_native")),
        )).alias("_q")
        return conform(hours.select("hour", quotes).select("hour", "_q.*"), "prices_hourly")

    @cached_property
    def native_balances(self) -> DataFrame:
        own = self.events.filter(F.col("event_type") == "view")
        df = own.groupBy(
            F.col("day").alias("block_date"), F.upper("wallet").alias("address")
        ).agg(F.max("value").alias("balance"), F.max("cents").alias("_c"))
        raw = (F.col("_c").cast("decimal(20,0)") * F.lit(CENT).cast("decimal(17,0)")).cast(RAW)
        return conform(df.withColumn("balance_raw", raw), "native_balances_daily")

    @cached_property
    def native_transfers(self) -> DataFrame:
        df = self.events.filter(F.col("event_type") == "purchase").select(
            F.col("ts").alias("block_timestamp"), F.col("wallet").alias("from_address"),
            F.concat(F.lit("0xd"), (F.col("k") % 40).cast("string")).alias("to_address"),
            F.col("value").alias("amount"),
        )
        return conform(df, "native_transfers")

    @cached_property
    def wallet_map(self) -> DataFrame:
        """Two wallets per validator: its own and its payout wallet."""
        roles = F.explode(F.array(
            F.struct(F.col("vid").alias("w"), F.lit("authority").alias("wallet_role")),
            F.struct((F.col("vid") + VALIDATORS).alias("w"), F.lit("payout").alias("wallet_role")),
        ))
        df = self.events.select("vid").distinct().select("vid", roles.alias("r")).select(
            F.col("vid").alias("validator_id"),
            F.concat(F.lit("0xd"), F.col("r.w").cast("string")).alias("wallet_address"),
            F.col("r.wallet_role").alias("wallet_role"),
        )
        return conform(df, "wallet_map")

    @cached_property
    def max_blocks(self) -> DataFrame:
        df = self.events.groupBy(F.col("day").alias("block_date")).agg(
            F.max("event_id").alias("block_number")
        )
        return conform(df, "max_block_by_date")

    @cached_property
    def labels(self) -> DataFrame:
        key = F.col("s_suppkey")
        named = (key < 10) & (key % 3 == 0)
        df = self.table("supplier").select(
            F.upper(pick(SAMPLE_ADDRESSES, key % 10)).alias("address"),
            F.col("s_name").alias("address_name"), F.lit("label").alias("label"),
            F.when(named, "validator").otherwise("exchange").alias("label_subtype"),
        )
        return conform(df, "labels")

    @cached_property
    def seed(self) -> DataFrame:
        key = F.col("c_custkey")
        df = self.table("customer").select(
            key.alias("validator_id"), F.col("c_name").alias("validator_name"),
            F.concat(F.lit("https://"), F.lower("c_mktsegment")).alias("website"),
            F.lit(None).cast("string").alias("image"),
            F.when(key % 5 != 4, F.concat(F.lit("City, "), key.cast("string"))).alias("city"),
            F.col("c_nationkey").cast("string").alias("region"),
            F.col("c_mktsegment").alias("country"), F.lit("UTC").alias("timezone"),
            F.col("c_acctbal").alias("latitude"), (F.col("c_acctbal") * -1).alias("longitude"),
            F.lit(None).cast("string").alias("ip_address"),
        )
        return conform(df, "validator_locations")

    @cached_property
    def _state_days(self) -> DataFrame:
        """Integer state per validator and day, and which response to return."""
        cents = F.col("cents")
        mark = (F.col("vid") + F.dayofmonth("day"))
        return self.events.groupBy("vid", "day").agg(
            F.sum(cents).alias("all_cents"), F.count("*").alias("n"),
            F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", cents)), F.lit(0)).alias("in_cents"),
            F.coalesce(F.sum(F.when(F.col("event_type") == "click", cents)), F.lit(0)).alias("out_cents"),
            F.max("event_id").alias("last_block"),
        ).withColumn("mark", mark).withColumn("dom", F.dayofmonth("day"))

    @staticmethod
    def _wide(cents: Column) -> Column:
        return F.lpad(F.concat(F.lower(F.hex(cents)), F.lit(SHIFT_HEX)), 64, "0")

    @staticmethod
    def _answer(words: list[Column]) -> Column:
        mark = F.col("mark")
        full = F.concat(F.lit("0x"), *words)
        payload = F.when(mark % 13 == 0, F.lit("0x")).when(mark % 17 != 0, full)
        return F.to_json(F.struct(F.struct(payload.alias("result")).alias("data")))

    @cached_property
    def validator_responses(self) -> DataFrame:
        vid, all_cents = F.col("vid"), F.col("all_cents")
        overflow = F.lit("f" * 64)
        stake = F.lit(1_000_000_000) + all_cents
        key = (
            F.when(vid == 5, "02" + "00" * 31 + "05")  # no curve point has this x
            .otherwise(pick(SAMPLE_KEYS, vid % 10))
        )
        has_key = vid != 7
        words = [
            address_word(F.concat(F.lit("0x"), F.lower(F.hex(vid + 256)))),
            int_word(vid % 3),
            self._wide(stake),
            F.when(F.col("mark") % 5 == 0, overflow).otherwise(self._wide(F.col("n"))),
            int_word((vid + 1) * CENT), self._wide(all_cents),
            self._wide(stake + F.col("in_cents")), int_word((vid + 2) * CENT),
            self._wide(stake - F.col("out_cents")), int_word((vid + 3) * CENT),
            int_word(F.lit(12 * 32)),
            int_word(F.when(has_key, 15 * 32).otherwise(13 * 32)),
            F.when(has_key, F.concat(int_word(F.lit(33)), F.rpad(key, 128, "0"))).otherwise(int_word(F.lit(0))),
            int_word(F.lit(48)), F.rpad(F.concat(F.sha2(F.col("vid").cast("string"), 256), F.md5(F.col("vid").cast("string"))), 128, "0"),
        ]
        df = self._state_days.select(
            F.col("day").alias("snapshot_date"), vid.alias("validator_id"),
            F.col("last_block").alias("snapshot_block"), self._answer(words).alias("response"),
        )
        return conform(df, "validator_responses")

    @cached_property
    def delegator_responses(self) -> DataFrame:
        vid, dom = F.col("vid"), F.col("dom")
        overflow = F.lit("f" * 64)
        words = [
            self._wide(F.col("in_cents") + 1000),
            F.when(F.col("mark") % 5 == 0, overflow).otherwise(int_word(F.col("n"))),
            self._wide(F.col("all_cents")), self._wide(F.col("in_cents")),
            self._wide(F.col("out_cents")), int_word(dom), int_word(dom + 1),
        ]
        df = self._state_days.select(
            F.col("day").alias("snapshot_date"), vid.alias("validator_id"),
            F.concat(F.lit("0xd"), vid.cast("string")).alias("auth_address"),
            F.col("last_block").alias("snapshot_block"), self._answer(words).alias("response"),
        )
        return conform(df, "delegator_responses")

    @cached_property
    def set_responses(self) -> DataFrame:
        """Three pages per epoch; the last one has no result."""
        number = F.col("o_orderkey")
        epochs = self._first_blocks.select(F.floor(number / BLOCKS_PER_EPOCH).alias("epoch"), number.alias("epoch_start_block"))
        members = F.filter(
            F.sequence(F.lit(0).cast("bigint"), F.lit(VALIDATORS - 1).cast("bigint")),
            lambda v: (F.col("epoch") + v) % 5 != 0,
        )
        paged = epochs.withColumn("members", members).withColumn(
            "start_index", F.explode(F.array(*[F.lit(i * SET_PAGE).cast("bigint") for i in range(3)]))
        ).withColumn(
            "page", F.slice("members", (F.col("start_index") + 1).cast("int"), F.lit(SET_PAGE))
        )
        ids = F.array_join(F.transform("page", int_word), "")
        full = F.concat(
            F.lit("0x"),
            int_word((F.size("page") < SET_PAGE).cast("int")),
            int_word(F.col("start_index") + F.size("page")), int_word(F.lit(96)),
            int_word(F.size("page")), ids,
        )
        payload = F.when(F.col("start_index") < 2 * SET_PAGE, full)
        df = paged.withColumn(
            "response", F.to_json(F.struct(F.struct(payload.alias("result")).alias("data")))
        )
        return conform(df, "set_responses")

    # --- facts and published tables -------------------------------------------

    def fact(self, name: str) -> DataFrame:
        if name not in self._facts:
            self._facts[name] = events.fact(self.event_logs, name)
        return self._facts[name]

    @cached_property
    def created(self) -> DataFrame:
        return self.fact("validators_created")

    @cached_property
    def decoded(self) -> DataFrame:
        return snapshots.snapshot_get_validator(self.validator_responses)

    @cached_property
    def validator_snapshots(self) -> DataFrame:
        return snapshots.fact_validator_snapshots(self.decoded, self.prices)

    @cached_property
    def self_snapshots(self) -> DataFrame:
        return snapshots.fact_validator_self_delegation_snapshots(
            self.delegator_responses, self.prices
        )

    @cached_property
    def addresses(self) -> DataFrame:
        return snapshots.validator_addresses(self.created, self.decoded)

    @cached_property
    def validators(self) -> DataFrame:
        return validators.dim_validators(
            self.created, self.addresses, self.decoded, self.labels, self.seed
        )

    @cached_property
    def validator_set(self) -> DataFrame:
        return snapshots.snapshot_validator_set(self.set_responses)

    @cached_property
    def rewards(self) -> DataFrame:
        return self.fact("validator_rewards")

    @cached_property
    def epochs(self) -> DataFrame:
        return blocks.dim_epochs(self.fact("epoch_changes"), self.blocks)

    @cached_property
    def fees(self) -> DataFrame:
        return blocks.fact_block_priority_fees(self.transactions, self.blocks, self.rewards)

    def stake_balances(self, validators: DataFrame | None = None, **window) -> DataFrame:
        return balances.ez_staking_balances_daily(
            self.fact("delegations"), self.fact("undelegations"), self.fact("withdrawals"),
            validators, as_of=window.pop("as_of", AS_OF), **window,
        )

    def performance(self, validators: DataFrame | None = None) -> DataFrame:
        return blocks.ez_validator_epoch_performance(
            self.validator_set, self.created, self.epochs, self.validator_snapshots,
            blocks.ez_block_production(self.rewards), validators,
        )

    def earnings(self, validators: DataFrame | None = None) -> DataFrame:
        return earnings.ez_validator_earnings(
            self.self_snapshots, self.fact("rewards_claimed"), self.created, self.fees, validators
        )

    def compound_decision(self, validators: DataFrame | None = None) -> DataFrame:
        return decisions.ez_compound_decision(
            self.self_snapshots, self.prices, self.fact("rewards_claimed"), self.created,
            self.earnings(), validators, as_of=AS_OF,
        )
