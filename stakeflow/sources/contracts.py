"""Input contracts: the columns and types each input must have."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


TYPES = {
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "decimal(38,0)": T.DecimalType(38, 0),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    pairs = (column.split(" ") for column in columns.split(", "))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


CONTRACTS: dict[str, T.StructType] = {
    "event_logs": _struct(
        "block_number bigint, block_timestamp timestamp_ntz, tx_hash string, event_index int, "
        "contract_address string, event_name string, decoded_log string, "
        "full_decoded_log string, origin_from_address string, origin_to_address string, "
        "origin_function_signature string, tx_succeeded boolean, event_log_id string, "
        "inserted_timestamp timestamp_ntz, modified_timestamp timestamp_ntz"
    ),
    "blocks": _struct("block_number bigint, miner string, base_fee_per_gas decimal(38,0)"),
    "transactions": _struct(
        "block_number bigint, block_timestamp timestamp_ntz, tx_hash string, gas_used bigint, "
        "effective_gas_price double, modified_timestamp timestamp_ntz"
    ),
    "prices_hourly": _struct("hour timestamp_ntz, price double, is_native boolean"),
    "native_balances_daily": _struct(
        "block_date date, address string, balance double, balance_raw decimal(38,0)"
    ),
    "labels": _struct("address string, address_name string, label string, label_subtype string"),
    "validator_locations": _struct(
        "validator_id bigint, validator_name string, website string, image string, city string, "
        "region string, country string, timezone string, latitude double, longitude double, "
        "ip_address string"
    ),
    "max_block_by_date": _struct("block_date date, block_number bigint"),
    "validator_responses": _struct(
        "snapshot_date date, validator_id bigint, snapshot_block bigint, response string"
    ),
    "delegator_responses": _struct(
        "snapshot_date date, validator_id bigint, auth_address string, snapshot_block bigint, "
        "response string"
    ),
    "set_responses": _struct(
        "epoch bigint, epoch_start_block bigint, start_index bigint, response string"
    ),
    "native_transfers": _struct(
        "block_timestamp timestamp_ntz, from_address string, to_address string, amount double"
    ),
    "wallet_map": _struct("validator_id bigint, wallet_address string, wallet_role string"),
}


class ContractError(ValueError):
    """An input lacks a column or has one of an unusable type."""


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Check ``df`` against its contract and return exactly the contract's columns.

    Numbers may be widened or narrowed to the contract's numeric type and
    timestamps may lose their zone; anything else must match.
    """
    contract = CONTRACTS[name]
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in contract.fields:
        if field.name not in have:
            raise ContractError(f"{name}: column {field.name!r} is missing")
        kind = have[field.name]
        compatible = (
            kind == field.dataType
            or (_numeric(kind) and _numeric(field.dataType))
            or (isinstance(kind, T.TimestampType) and isinstance(field.dataType, T.TimestampNTZType))
            or (field.name.endswith("decoded_log") and isinstance(kind, T.VariantType))
        )
        if not compatible:
            raise ContractError(
                f"{name}.{field.name}: {kind.simpleString()} instead of "
                f"{field.dataType.simpleString()}"
            )
        keep = kind == field.dataType or isinstance(kind, T.VariantType)
        out.append(F.col(field.name) if keep else F.col(field.name).cast(field.dataType))
    return df.select(*out)
