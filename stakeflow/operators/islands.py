"""Gaps and islands: runs of equal values along an order, kept as ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stakeflow.operators.ordered import SPAN, Depth, with_spans


def islands(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    ts: str,
    width: int | Depth | None = None,
    end: str | None = None,
    end_ts: str | None = None,
    count: str | None = None,
) -> DataFrame:
    """(key, value, start, end, start_ts, end_ts, n, next_value, is_current).

    A run ends where ``value`` changes along ``order``. Rows may already be ranges:
    ``end``, ``end_ts`` and ``count`` then name their upper bounds and sizes.

    Runs are first closed inside each span of ``order``. Only the first and last
    run of a span can continue in a neighbour, so only those meet in a per-key
    window; a key whose value changes on every row does not pile up in one task.
    """
    rows = df.select(
        F.col(key),
        F.col(value),
        F.col(order).alias("start"),
        F.col(end or order).alias("end"),
        F.col(ts).alias("start_ts"),
        F.col(end_ts or ts).alias("end_ts"),
        (F.col(count) if count else F.lit(1)).cast("bigint").alias("n"),
    )
    rows = with_spans(rows, [key], "start", width)

    inside = Window.partitionBy(key, SPAN).orderBy("start")
    changed = F.when(
        (F.row_number().over(inside) == 1) | ~F.col(value).eqNullSafe(F.lag(value).over(inside)), 1
    ).otherwise(0)
    numbered = rows.withColumn("_changed", changed).withColumn(
        "_run", F.sum("_changed").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    runs = numbered.groupBy(key, SPAN, "_run", value).agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("n").alias("n"),
    )
    in_span = Window.partitionBy(key, SPAN).orderBy("_run")
    runs = runs.withColumns(
        {
            "_next": F.lead(F.struct(value)).over(in_span),
            "_first": F.col("_run") == 1,
        }
    ).withColumn("_last", F.col("_next").isNull())

    inner = runs.filter(~F.col("_first") & ~F.col("_last"))

    along = Window.partitionBy(key).orderBy(SPAN, "_run")
    edges = runs.filter(F.col("_first") | F.col("_last")).withColumns(
        {
            "_starts": F.when(
                F.col("_first") & F.lag(F.struct(value)).over(along).eqNullSafe(F.struct(value)), 0
            ).otherwise(1),
            "_next": F.coalesce("_next", F.lead(F.struct(value)).over(along)),
        }
    )
    edges = edges.withColumn(
        "_range", F.sum("_starts").over(along.rowsBetween(Window.unboundedPreceding, 0))
    )
    merged = edges.groupBy(key, "_range", value).agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("n").alias("n"),
        # The fragment in the latest span knows what follows the range.
        F.max_by(F.struct("_next"), F.struct(SPAN, "_run")).alias("_tail"),
    )
    columns = [key, value, "start", "end", "start_ts", "end_ts", "n"]
    return (
        inner.select(*columns, "_next")
        .unionByName(merged.select(*columns, F.col("_tail._next").alias("_next")))
        .select(
            *columns,
            F.col(f"_next.{value}").alias("next_value"),
            F.col("_next").isNull().alias("is_current"),
        )
    )
