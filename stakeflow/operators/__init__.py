"""Table operators that work on any DataFrame."""

from stakeflow.operators.aggregates import (
    daily_last,
    full_outer_measures,
    latest_per_key,
    weighted_expectation,
)
from stakeflow.operators.asof import asof_join
from stakeflow.operators.islands import islands
from stakeflow.operators.ordered import DEPTH, Depth, fill_last, next_values, prefix_sums
from stakeflow.operators.series import (
    densify,
    forward_fill,
    hold_until_next,
    rolling_mean_rows,
    running_balance,
)

__all__ = [
    "DEPTH",
    "Depth",
    "asof_join",
    "daily_last",
    "densify",
    "fill_last",
    "forward_fill",
    "full_outer_measures",
    "hold_until_next",
    "islands",
    "latest_per_key",
    "next_values",
    "prefix_sums",
    "rolling_mean_rows",
    "running_balance",
    "weighted_expectation",
]
