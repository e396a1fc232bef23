"""Grouped operators: latest row, daily close, weighted shares, outer measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stakeflow.functions.numeric import exact_sum, ratio


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (then ``tie``).

    An aggregate rather than a window, so each map task sends one row per key.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = df.filter(F.col(order).isNotNull())
    best = F.max_by(F.struct(*rest), F.struct(order, *tie)).alias("_best")
    return ranked.groupBy(*keys).agg(best).select(*keys, "_best.*")


def daily_last(df: DataFrame, ts: str, value: str, out: str | None = None) -> DataFrame:
    """(price_date, value): the value at the last timestamp of each day."""
    return df.groupBy(F.to_date(ts).alias("price_date")).agg(
        F.max_by(value, ts).alias(out or value)
    )


def weighted_expectation(
    df: DataFrame, group: Sequence[str], weight: str, total: str
) -> DataFrame:
    """Share of ``weight`` within the group and the share of ``total`` it implies.

    Group totals are joined back instead of taken by a window, so a large group
    is aggregated on the map side and its rows stay spread.
    """
    totals = df.groupBy(*group).agg(exact_sum(weight).alias("group_weight"))
    share = ratio(weight, "group_weight")
    return df.join(totals, list(group), "left").withColumns(
        {
            "weight_share": F.round(share, 6),
            "expected": F.round(F.col(total) * share, 2),
        }
    )


def full_outer_measures(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Full outer join on keys; measures missing on one side are zero."""
    return left.join(right, list(keys), "full").na.fill(0, list(measures))
