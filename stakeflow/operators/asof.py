"""As-of join: each left row with the latest earlier right row of the same key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stakeflow.operators.ordered import fill_last


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    right_cols: dict[str, str],
    strict: bool = True,
    right_tie: Sequence[str] = (),
    width: int | None = None,
) -> DataFrame:
    """Left rows plus ``{output: right column}``, NULL where nothing precedes them.

    ``strict`` asks for right rows strictly before the left row; otherwise equal
    timestamps match. ``right_tie`` orders right rows that share a timestamp.
    Both sides are stacked and scanned once in time order, so reused keys cost no
    fan-out and a key that holds much of the table is still cut into spans.
    """
    ties = [f"_t{i}" for i in range(len(right_tie))]
    left_rows = left.select(
        *[F.col(k) for k in keys],
        F.col(left_ts).alias("_ts"),
        F.lit(0 if strict else 1).alias("_side"),
        F.struct(*left.columns).alias("_left"),
    )
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    right_rows = right.filter(known).select(
        *[F.col(k) for k in keys],
        F.col(right_ts).alias("_ts"),
        F.lit(1 if strict else 0).alias("_side"),
        *[F.col(c).alias(t) for c, t in zip(right_tie, ties)],
        F.struct(*[F.col(c).alias(out) for out, c in right_cols.items()]).alias("_match"),
    )
    stacked = left_rows.unionByName(right_rows, allowMissingColumns=True)
    scanned = fill_last(stacked, keys, "_ts", ["_match"], tie=["_side", *ties], width=width)
    return scanned.filter(F.col("_left").isNotNull()).select(
        "_left.*", *[F.col(f"_match.{out}").alias(out) for out in right_cols]
    )
