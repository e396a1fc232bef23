"""The validator dimension and the enrichment every published table shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stakeflow.functions.keys import surrogate_key
from stakeflow.functions.numeric import tokens
from stakeflow.operators import latest_per_key

SMALL = 20_000  # validators; three short columns each, about 2 MB
SEED_COLUMNS = [
    "website", "image", "city", "region", "country", "timezone", "latitude", "longitude",
    "ip_address",
]


def dim_validators(
    created: DataFrame, addresses: DataFrame, snapshots: DataFrame, labels: DataFrame,
    seed: DataFrame,
) -> DataFrame:
    """One row per validator: creation, latest state, address, label, location."""
    base = created.select(
        "validator_id", "auth_address",
        F.col("block_timestamp").alias("created_at"),
        F.col("block_number").alias("created_block"),
        F.col("tx_hash").alias("creation_tx_hash"),
        (tokens("commission") * 100).alias("initial_commission_pct"),
    )
    latest = latest_per_key(
        snapshots.select(
            "validator_id", "snapshot_date", "flags", "execution_commission_pct",
            "consensus_commission_pct", "secp_pubkey", "bls_pubkey",
        ),
        ["validator_id"], "snapshot_date",
    ).withColumnsRenamed({
        "snapshot_date": "latest_snapshot_date",
        "execution_commission_pct": "current_commission_pct",
    })
    names = labels.filter(F.col("label_subtype") == "validator").select(
        F.lower("address").alias("_address"), F.col("address_name").alias("_label_name")
    )
    located = seed.select(
        "validator_id", F.col("validator_name").alias("_seed_name"), *SEED_COLUMNS
    )
    joined = (
        base.join(addresses.select("validator_id", "consensus_address"), "validator_id", "left")
        .join(latest, "validator_id", "left")
        .withColumn("_address", F.lower("consensus_address"))
        .join(names, "_address", "left")
        .join(located, "validator_id", "left")
    )
    status = (
        F.when(F.col("flags") == 0, "active")
        .when(F.col("flags") == 1, "stake_too_low")
        .otherwise("unknown")
    )
    return joined.select(
        "validator_id",
        F.coalesce("_label_name", "_seed_name").alias("validator_name"),
        "auth_address", "consensus_address", "created_at", "created_block", "creation_tx_hash",
        "initial_commission_pct", "current_commission_pct", "consensus_commission_pct",
        "flags", status.alias("status"), "secp_pubkey", "bls_pubkey", "latest_snapshot_date",
        *SEED_COLUMNS,
        surrogate_key("validator_id").alias("gov__dim_validators_id"),
    )


def _resolved(validators: DataFrame) -> DataFrame:
    """(validator_id, validator_name, consensus_address), as local rows if they are few.

    The answer is kept with the frame it comes from, so tables enriched from one dimension share it.
    """
    found = getattr(validators, "_resolved_names", None)
    if found is None:
        found = validators.select("validator_id", "validator_name", "consensus_address")
        rows = found.limit(SMALL + 1).collect()
        if len(rows) <= SMALL:
            found = validators.sparkSession.createDataFrame(rows, found.schema)
        validators._resolved_names = found
    return found


def enrich(df: DataFrame, validators: DataFrame | None) -> DataFrame:
    """Adds validator_name and consensus_address after validator_id.

    A dimension of at most ``SMALL`` validators is resolved first, so that the planner knows its
    size and broadcasts it; then the facts, hot validators and all, are not shuffled for two names.
    A larger one is joined as it is.
    """
    if validators is None:
        return df
    names = _resolved(validators)
    at = df.columns.index("validator_id") + 1
    order = [*df.columns[:at], "validator_name", "consensus_address", *df.columns[at:]]
    return df.join(names, "validator_id", "left").select(*order)
