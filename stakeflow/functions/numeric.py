"""Token units, exact sums over floating values, and null-aware comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql.window import WindowSpec

RAW = "decimal(38,0)"
EXACT = "decimal(38,18)"

# Decimal places of the chain's units.
WEI_PER_TOKEN = 1e18
WEI_PER_GWEI = 1e9
WEI_PER_PERCENT = 1e16


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(raw: Column | str) -> Column:
    """Raw wei to whole tokens."""
    return _col(raw).cast("double") / F.lit(WEI_PER_TOKEN)


def percent(raw: Column | str) -> Column:
    """A commission in 1e18ths of one to percent."""
    return _col(raw).cast("double") / F.lit(WEI_PER_PERCENT)


def exact_sum(x: Column | str, window: WindowSpec | None = None) -> Column:
    """Sum of doubles that does not depend on row order or task retries."""
    total = F.sum(_col(x).cast(EXACT))
    return (total.over(window) if window is not None else total).cast("double")


def exact_avg(x: Column | str, window: WindowSpec | None = None) -> Column:
    """Mean of doubles that does not depend on row order or task retries."""
    n = F.count(_col(x))
    return exact_sum(x, window) / F.nullif(n.over(window) if window is not None else n, F.lit(0))


def micro(raw: Column | str) -> Column:
    """Raw wei rounded half up to the sixth decimal of a token, still in wei."""
    return F.round(_col(raw).cast(RAW), -12)


def clamped_tokens(raw: Column | str, eps: str = "0.0001") -> Column:
    """Tokens, with magnitudes below ``eps`` reported as exactly zero."""
    c = _col(raw)
    limit = F.lit(eps).cast("decimal(20,18)") * F.lit(10**18).cast("decimal(19,0)")
    return F.when(F.abs(c) < limit, F.lit(0.0)).otherwise(tokens(c))


def usd(amount: Column | str, price: Column | str) -> Column:
    return F.round(_col(amount) * _col(price), 2)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when the denominator is zero."""
    return _col(num) / F.nullif(_col(den), F.lit(0).cast("double"))


def strict_extreme(fn, *cols: Column) -> Column:
    """``greatest``/``least`` that return NULL as soon as one argument is NULL."""
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(known, fn(*cols))
