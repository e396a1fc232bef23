"""Series operators: densify, forward fill, running balances, rolling means."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stakeflow.functions.numeric import EXACT, RAW, clamped_tokens
from stakeflow.operators.ordered import fill_last, prefix_sums


def hold_until_next(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    end: dt.date,
    changes: Sequence[str] = (),
    drop_when: Column | None = None,
) -> DataFrame:
    """Repeat each row on every day until the key's next row, and up to ``end``.

    Input has at most one row per key and day. ``changes`` are zero on repeated
    days. Rows for which ``drop_when`` holds are not repeated. ``is_repeated``
    tells copies from originals.

    The gaps are opened from the sparse rows, so nothing is shuffled densely and
    no keys-by-dates product is built.
    """
    by_key = Window.partitionBy(*keys).orderBy(date_col)
    # least() skips the NULL that follows a key's last row.
    held = F.least(F.date_sub(F.lead(date_col).over(by_key), 1), F.lit(end))
    last_day = F.greatest(F.col(date_col), held)
    if drop_when is not None:
        last_day = F.when(drop_when, F.col(date_col)).otherwise(last_day)
    opened = (
        df.withColumn("_until", last_day)
        .withColumn("_day", F.explode(F.sequence(F.col(date_col), F.col("_until"))))
        .withColumn("is_repeated", F.col("_day") != F.col(date_col))
    )
    values = [
        F.col("_day").alias(date_col)
        if c == date_col
        else F.when(F.col("is_repeated"), F.lit(0)).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
        if c in changes
        else F.col(c)
        for c in df.columns
    ]
    return opened.select(*values, "is_repeated")


def densify(df: DataFrame, keys: Sequence[str], date_col: str, end: dt.date) -> DataFrame:
    """One row per key and day from the key's first day to ``end``; gaps are NULL."""
    spine = df.groupBy(*keys).agg(F.min(date_col).alias("_from"))
    days = spine.filter(F.col("_from") <= F.lit(end)).select(
        *keys, F.explode(F.sequence(F.col("_from"), F.lit(end))).alias(date_col)
    )
    return days.join(df, [*keys, date_col], "left")


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    tie: Sequence[str] = (),
    width: int | None = None,
) -> DataFrame:
    """Fill NULLs from the last earlier value; ``is_forward_filled`` marks rows where
    every one of ``cols`` was missing."""
    missing = F.lit(True)
    for c in cols:
        missing = missing & F.col(c).isNull()
    return fill_last(df.withColumn("is_forward_filled", missing), keys, order, cols, tie, width)


def running_balance(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: dict[str, str],
    tie: Sequence[str] = (),
    seed: DataFrame | None = None,
    width: int | None = None,
) -> DataFrame:
    """Running balances ``{output: raw change}`` in tokens, clamped near zero.

    Changes are raw integer amounts, so the sums are exact. ``seed`` holds earlier
    raw balances per key under the output names.
    """
    sums = {f"_{out}": raw for out, raw in cols.items()}
    summed = prefix_sums(
        df.withColumns({raw: F.col(raw).cast(RAW) for raw in cols.values()}),
        keys, order, sums, tie, width,
    )
    start = {out: F.lit(0).cast(RAW) for out in cols}
    if seed is not None:
        named = seed.select(*keys, *[F.col(out).cast(RAW).alias(f"_seed_{out}") for out in cols])
        summed = summed.join(named, list(keys), "left")
        start = {out: F.coalesce(F.col(f"_seed_{out}"), F.lit(0).cast(RAW)) for out in cols}
    balances = summed.withColumns(
        {
            out: clamped_tokens((start[out] + F.coalesce(f"_{out}", F.lit(0))).cast(RAW))
            for out in cols
        }
    )
    return balances.select(*df.columns, *cols)


def rolling_mean_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    sizes: dict[str, int],
    tie: Sequence[str] = (),
    block: int = 100_000,
    width: int | None = None,
) -> DataFrame:
    """Mean of the current and the n-1 preceding rows, for each ``{output: n}``.

    Rows are numbered with a prefix count, cut into blocks of ``block`` rows, or of the
    widest frame if that is longer, and each block also receives the rows just before
    it. A long series is therefore averaged by many tasks.
    """
    reach = max(sizes.values()) - 1
    block = max(block, reach + 1)
    numbered = prefix_sums(
        df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, {"_row": "_one"}, tie, width
    )
    at = F.col("_row") - 1
    own = F.floor(at / block)
    lent = F.when(at % block >= block - reach, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered.withColumn("_own", own).withColumn("_block", F.explode(lent))
    in_block = Window.partitionBy(*keys, "_block").orderBy("_row")
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    # A frame is the difference of two running sums, exact in decimals, so its cost
    # does not grow with its length.
    running = spread.withColumns({
        "_sum": F.sum(F.col(value).cast(EXACT)).over(upto), "_n": F.count(value).over(upto),
    })

    def mean(n: int) -> Column:
        earlier = F.coalesce(F.lag("_sum", n).over(in_block), F.lit(0).cast(EXACT))
        rows = F.col("_n") - F.coalesce(F.lag("_n", n).over(in_block), F.lit(0))
        return (F.col("_sum") - earlier).cast(EXACT).cast("double") / F.nullif(rows, F.lit(0))

    averaged = running.withColumns({out: mean(n) for out, n in sizes.items()})
    return averaged.filter(F.col("_block") == F.col("_own")).select(*df.columns, *sizes)
