"""What to load next: watermarks, missing periods, reprocess windows.

Each helper runs one small aggregate on the target and turns the answer into a
literal filter, which reaches the Parquet scan of the source.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

BEGINNING = dt.datetime(1970, 1, 1)


def high_watermark(target: DataFrame | None, col: str, default):
    """Largest value of ``col`` in the target, or ``default`` when there is none."""
    if target is None:
        return default
    found = target.agg(F.max(col)).first()[0]
    return default if found is None else found


def since_watermark(
    src: DataFrame, target: DataFrame | None, col: str = "modified_timestamp", default=BEGINNING
) -> DataFrame:
    """Source rows newer than anything in the target."""
    mark = high_watermark(target, col, default)
    if isinstance(mark, dt.datetime):
        literal = F.lit(mark.isoformat(sep=" ")).cast(src.schema[col].dataType)
        return src.filter(F.col(col) > literal)
    return src.filter(F.col(col) > F.lit(mark))


def since_block(src: DataFrame, target: DataFrame | None, end_col: str = "end_block") -> DataFrame:
    """Source blocks above the target's highest block."""
    return src.filter(F.col("block_number") > F.lit(high_watermark(target, end_col, 0)))


def missing_periods(
    src: DataFrame,
    target: DataFrame | None,
    col: str,
    n: int | None = None,
    earliest=None,
    before=None,
) -> DataFrame:
    """Rows of ``src`` in periods that the target does not hold yet: all, or those of the ``n`` oldest periods."""
    periods = src
    if earliest is not None:
        periods = periods.filter(F.col(col) >= F.lit(earliest))
    if before is not None:
        periods = periods.filter(F.col(col) < F.lit(before))
    if target is not None:
        periods = periods.join(target.select(col).distinct(), col, "left_anti")
    if n is None:
        return periods
    oldest = periods.select(col).distinct().orderBy(col).limit(n)
    return periods.join(oldest, col, "left_semi")


def window_start(target: DataFrame, col: str, back: int):
    """Latest period of the target minus ``back`` days (dates) or units (numbers)."""
    latest = high_watermark(target, col, None)
    if latest is None:
        return None
    return latest - dt.timedelta(days=back) if isinstance(latest, dt.date) else latest - back


def reprocess_window(
    src: DataFrame, target: DataFrame, src_col: str, target_col: str, back: int,
    inclusive: bool = False,
) -> DataFrame:
    """Source rows inside the reprocess window; everything when the target is empty."""
    start = window_start(target, target_col, back)
    if start is None:
        return src
    edge = F.lit(start)
    return src.filter(F.col(src_col) >= edge if inclusive else F.col(src_col) > edge)
