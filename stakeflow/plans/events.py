"""Typed facts from decoded contract events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stakeflow.functions.keys import surrogate_key
from stakeflow.functions.numeric import RAW, tokens
from stakeflow.sources.tables import staking_events

CONTEXT = [
    "block_number", "block_timestamp", "tx_hash", "event_index", "contract_address", "event_name",
]
ORIGIN = ["origin_from_address", "origin_to_address", "origin_function_signature"]

# event name, key column, {output: (JSON path, type)}
FACTS: dict[str, tuple[str, str, dict[str, tuple[str, str]]]] = {
    "validators_created": (
        "ValidatorCreated", "fact_validators_created_id",
        {
            "validator_id": ("validatorId", "bigint"),
            "auth_address": ("authAddress", "string"),
            "commission": ("commission", RAW),
        },
    ),
    "delegations": (
        "Delegate", "fact_delegations_id",
        {
            "validator_id": ("validatorId", "bigint"),
            "delegator_address": ("delegator", "string"),
            "amount_raw": ("amount", RAW),
            "activation_epoch": ("activationEpoch", "bigint"),
        },
    ),
    "undelegations": (
        "Undelegate", "fact_undelegations_id",
        {
            "validator_id": ("validatorId", "bigint"),
            "delegator_address": ("delegator", "string"),
            "withdraw_id": ("withdrawId", "bigint"),
            "amount_raw": ("amount", RAW),
            "activation_epoch": ("activationEpoch", "bigint"),
        },
    ),
    "withdrawals": (
        "Withdraw", "fact_withdrawals_id",
        {
            "validator_id": ("validatorId", "bigint"),
            "delegator_address": ("delegator", "string"),
            "withdraw_id": ("withdrawId", "bigint"),
            "amount_raw": ("amount", RAW),
            "withdraw_epoch": ("withdrawEpoch", "bigint"),
        },
    ),
    "validator_rewards": (
        "ValidatorRewarded", "fact_validator_rewards_id",
        {
            "validator_id": ("validatorId", "bigint"),
            "reward_source": ("from", "string"),
            "amount_raw": ("amount", RAW),
            "epoch": ("epoch", "bigint"),
        },
    ),
    "rewards_claimed": (
        "ClaimRewards", "fact_rewards_claimed_id",
        {
            "validator_id": ("validatorId", "bigint"),
            "delegator_address": ("delegator", "string"),
            "amount_raw": ("amount", RAW),
            "epoch": ("epoch", "bigint"),
        },
    ),
    "validator_commission_changes": (
        "CommissionChanged", "fact_validator_commission_changes_id",
        {
            "validator_id": ("validatorId", "bigint"),
            "old_commission": ("oldCommission", RAW),
            "new_commission": ("newCommission", RAW),
        },
    ),
    "validator_status_changes": (
        "ValidatorStatusChanged", "fact_validator_status_changes_id",
        {
            "validator_id": ("validatorId", "bigint"),
            "flags": ("flags", RAW),
        },
    ),
    "epoch_changes": (
        "EpochChanged", "fact_epoch_changes_id",
        {
            "old_epoch": ("oldEpoch", "bigint"),
            "new_epoch": ("newEpoch", "bigint"),
        },
    ),
}


def with_json_fields(
    df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]], lenient: bool = False
) -> DataFrame:
    """Adds typed fields ``{output: (path, type)}`` of a JSON text or VARIANT column.

    Values are read as text first because 256-bit integers arrive quoted. Text is
    parsed into one struct in a projection of its own: reading fields directly off
    the parse would be optimised into one parse per field.
    """
    cast = Column.try_cast if lenient else Column.cast
    if isinstance(df.schema[column].dataType, T.VariantType):
        read = F.try_variant_get if lenient else F.variant_get
        return df.withColumns({
            out: cast(read(F.col(column), f"$.{path}", "string"), kind)
            for out, (path, kind) in fields.items()
        })
    ddl = ", ".join(f"`{path}` string" for path in dict.fromkeys(p for p, _ in fields.values()))
    return df.withColumn("_parsed", F.from_json(F.col(column), ddl)).withColumns({
        out: cast(F.col("_parsed").getField(path), kind) for out, (path, kind) in fields.items()
    }).drop("_parsed")


def extract_event(
    events: DataFrame,
    event_name: str,
    fields: Mapping[str, tuple[str, str]],
    scaled: Sequence[str] = (),
    key: str = "event_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of one event with typed fields; ``x_raw`` in ``scaled`` also yields ``x``."""
    rows = events.filter(F.col("event_name") == event_name)
    typed = with_json_fields(rows, "decoded_log", fields)
    typed = typed.withColumns({raw.removesuffix("_raw"): tokens(raw) for raw in scaled})
    out: list[str] = []
    for name in fields:
        out += [name, name.removesuffix("_raw")] if name in scaled else [name]
    return typed.select(
        *CONTEXT, *out, *ORIGIN, surrogate_key("tx_hash", "event_index").alias(key), *keep
    )


def fact(logs: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """One of the nine event facts, from raw logs."""
    event_name, key, fields = FACTS[name]
    scaled = [f for f in fields if f == "amount_raw"]
    return extract_event(staking_events(logs), event_name, fields, scaled, key, keep)


def fact_validators_created(logs: DataFrame) -> DataFrame:
    return fact(logs, "validators_created")


def fact_delegations(logs: DataFrame) -> DataFrame:
    return fact(logs, "delegations")


def fact_undelegations(logs: DataFrame) -> DataFrame:
    return fact(logs, "undelegations")


def fact_withdrawals(logs: DataFrame) -> DataFrame:
    return fact(logs, "withdrawals")


def fact_validator_rewards(logs: DataFrame) -> DataFrame:
    return fact(logs, "validator_rewards")


def fact_rewards_claimed(logs: DataFrame) -> DataFrame:
    return fact(logs, "rewards_claimed")


def fact_validator_commission_changes(logs: DataFrame) -> DataFrame:
    return fact(logs, "validator_commission_changes")


def fact_validator_status_changes(logs: DataFrame) -> DataFrame:
    return fact(logs, "validator_status_changes")


def fact_epoch_changes(logs: DataFrame) -> DataFrame:
    return fact(logs, "epoch_changes")
