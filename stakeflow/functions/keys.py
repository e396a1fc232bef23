"""Surrogate keys and audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the text of the columns; NULLs get a marker so they keep their place."""
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("_null_"))
        for c in cols
    ]
    return F.md5(F.concat_ws("-", *texts))


def with_audit(df: DataFrame) -> DataFrame:
    """Stamp a batch before it is written."""
    now = F.current_timestamp().cast("timestamp_ntz")
    return df.withColumns({"inserted_timestamp": now, "modified_timestamp": now})
