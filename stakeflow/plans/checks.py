"""Data checks: each returns the rows that fail."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakeflow.functions.times import as_timestamp

CheckId = tuple[str, str, str]  # table, check, column


def unique(df: DataFrame, *cols: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def recency(df: DataFrame, col: str, as_of: dt.date | dt.datetime, days: int = 2) -> DataFrame:
    """One row: the newest value and whether it is older than ``days`` before ``as_of``."""
    edge = as_timestamp(as_of) - dt.timedelta(days=days)
    latest = F.max(col)
    oldest_ok = F.lit(edge.isoformat(sep=" ")).cast(df.schema[col].dataType)
    return df.agg(
        F.lit(col).alias("column_name"), latest.alias("latest"),
        F.coalesce(latest < oldest_ok, F.lit(True)).alias("is_stale"),
    )


def recent(df: DataFrame, col: str, as_of: dt.date | dt.datetime, days: int = 2) -> DataFrame:
    """The failing form of ``recency``: empty when the data is fresh."""
    return recency(df, col, as_of, days).filter("is_stale")


def store_failures(failing: Mapping[CheckId, DataFrame], path: str) -> None:
    """Append the failing rows of each check, as JSON, under its table and name."""
    for (table, check, column), rows in failing.items():
        rows.select(
            F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"), F.to_json(F.struct("*")).alias("failing_row"),
        ).write.mode("append").partitionBy("table_name", "check_name").parquet(path)


def failure_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).groupBy("table_name", "check_name", "column_name").agg(
        F.count("*").alias("failures")
    )


def all_checks(
    df: DataFrame, table: str, *, not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = (),
    recent: Mapping[str, int] | None = None, as_of: dt.date | dt.datetime | None = None,
) -> DataFrame:
    """Every check of one table from one scan: (table_name, check_name, column_name, failing, n).

    Each row is turned into one finding per check (its key as JSON for ``unique``, itself as JSON where a
    ``not_null`` column is NULL, its value for ``recent``); one aggregate, combined on the map side, then
    yields the failing keys (``n`` > 1), the failing rows (``n`` copies) and, per recency column, one row when
    its newest value is older than ``days`` before ``as_of`` (``failing`` holds that value, NULL for none).
    """
    recent = dict(recent or {})
    if recent and as_of is None:
        raise ValueError("recency checks need as_of")
    whole = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    found = []
    for c in not_null:
        found.append(F.struct(F.lit("not_null").alias("check_name"), F.lit(c).alias("column_name"),
                              F.when(F.col(c).isNull(), whole).alias("failing"), F.lit(None).cast("string").alias("value")))
    for cols in unique:
        found.append(F.struct(F.lit("unique").alias("check_name"), F.lit(",".join(cols)).alias("column_name"),
                              F.to_json(F.struct(*[F.col(c) for c in cols])).alias("failing"),
                              F.lit(None).cast("string").alias("value")))
    for c in recent:
        found.append(F.struct(F.lit("recency").alias("check_name"), F.lit(c).alias("column_name"),
                              F.lit(None).cast("string").alias("failing"), F.col(c).cast("string").alias("value")))
    if not found:
        raise ValueError("no checks given")
    each = df.select(F.explode(F.array(*found)).alias("f")).select("f.*").filter(
        (F.col("check_name") != "not_null") | F.col("failing").isNotNull()
    )
    met = each.groupBy("check_name", "column_name", "failing").agg(F.count("*").alias("n"), F.max("value").alias("latest"))
    stale = F.lit(False)
    for c, days in recent.items():
        edge = (as_timestamp(as_of) - dt.timedelta(days=days)).isoformat(sep=" ")
        latest = F.col("latest").cast(df.schema[c].dataType)
        stale = stale | ((F.col("column_name") == c) & F.coalesce(latest < F.lit(edge).cast(df.schema[c].dataType), F.lit(True)))
    fails = F.when(F.col("check_name") == "unique", F.col("n") > 1).when(F.col("check_name") == "recency", stale).otherwise(True)
    return met.filter(fails).select(
        F.lit(table).alias("table_name"), "check_name", "column_name",
        F.when(F.col("check_name") == "recency", F.col("latest")).otherwise(F.col("failing")).alias("failing"), "n",
    )
