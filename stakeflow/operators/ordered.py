"""Ordered scans that never put a whole key into one task.

A plain window ``partitionBy(key).orderBy(t)`` sends every row of a key to one
task, which fails when one key holds a large share of the table. Here the key is
cut into *spans* of its ordering column. One small row per (key, span) is
aggregated with map-side combine, a window over those rows works out what each
span inherits from its neighbours, and that row is put in front of (or behind)
the span's own rows. The wide rows are shuffled once, by (key, span).

Spans only decide how the work is cut; results do not depend on their width.

Spans are cut by a fixed width of the ordering column (an hour, 32 days, a million units) or, with
``width=Depth(rows)``, by the data: keys of more than ``SPAN_ROWS`` rows get equi-depth cut points from an
approximate quantile sketch of their ordering column, so a burst of one key inside one hour is still
spread over tasks of about ``SPAN_ROWS`` rows. Equal ordering values always share a span.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

SPAN = "_span"
EDGE = "_edge"

HOUR_MICROS = 3_600_000_000
SPAN_ROWS = 1_000_000  # rows of a span cut by depth
CUTS = 256  # quantiles sketched per hot key; spans of one key at most this many
SMALL_KEYS = 10_000  # hot keys whose cut points are broadcast; more are joined


def span_of(df: DataFrame, order: str, width: int | None = None) -> Column:
    """Span number of a row: non-decreasing in ``order``.

    ``width`` counts hours for timestamps, days for dates, units for numbers.
    """
    kind = df.schema[order].dataType
    c = F.col(order)
    if isinstance(kind, T.TimestampNTZType):
        day = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
        return F.floor((day * 24 + F.hour(c)) / F.lit(width or 1))
    if isinstance(kind, T.TimestampType):
        return F.floor(F.unix_micros(c) / F.lit((width or 1) * HOUR_MICROS))
    if isinstance(kind, T.DateType):
        return F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / F.lit(width or 32))
    if isinstance(kind, (T.NumericType,)):
        return F.floor(c / F.lit(width or 1_000_000)).cast("bigint")
    raise TypeError(f"cannot cut {kind.simpleString()} column {order!r} into spans")


def _position(df: DataFrame, order: str) -> Column:
    """A number that does not decrease with ``order``."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{order}`)").cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(order)).cast("double")
    if isinstance(kind, T.DateType):
        return F.datediff(F.col(order), F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(order).cast("double")
    raise TypeError(f"cannot cut {kind.simpleString()} column {order!r} into spans")


def depth_spans(df: DataFrame, keys: Sequence[str], order: str, rows: int = SPAN_ROWS) -> DataFrame:
    """``df`` with ``SPAN``: 0 for keys of at most ``rows`` rows, else equi-depth spans of about ``rows`` rows.

    Rows are counted per key with map-side combine; only keys above ``rows`` are sketched, so there are at
    most (table rows / ``rows``) sketches. A key's cut points are every k-th of ``CUTS`` quantiles, k chosen
    for spans of about ``rows``; a row's span is the number of cut points below its value.
    """
    at = _position(df, order)
    hot = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows)
    few = hot.count() <= SMALL_KEYS
    chosen = F.broadcast(hot) if few else hot
    fractions = [i / CUTS for i in range(1, CUTS)]
    sketch = df.join(chosen, list(keys)).groupBy(*keys).agg(
        F.percentile_approx(at, fractions, 10_000).alias("_q"), F.first("_n").alias("_n")
    )
    step = F.greatest(F.lit(1), F.floor(F.lit(CUTS * rows) / F.col("_n")))
    cuts = sketch.select(*keys, F.array_distinct(F.filter("_q", lambda q, i: (i + 1) % step == 0)).alias("_cuts"))
    spanned = df.join(F.broadcast(cuts) if few else cuts, list(keys), "left")
    below = F.size(F.filter("_cuts", lambda c: c < at))
    return spanned.withColumn(SPAN, F.when(F.col("_cuts").isNull(), 0).otherwise(below).cast("bigint")).drop("_cuts")


class Depth(NamedTuple):
    """Spans cut by the data, of about ``rows`` rows each."""

    rows: int = SPAN_ROWS


DEPTH = Depth()


def with_spans(df: DataFrame, keys: Sequence[str], order: str, width: int | Depth | None) -> DataFrame:
    """``df`` with ``SPAN``, by a fixed width of ``order`` or, for a ``Depth``, by the data."""
    if isinstance(width, Depth):
        return depth_spans(df, keys, order, width.rows)
    return df.withColumn(SPAN, span_of(df, order, width))


def _rank_of(order: str, tie: Sequence[str]) -> Column:
    return F.struct(F.col(order), *[F.col(c) for c in tie])


def _with_edges(df: DataFrame, edges: DataFrame, position: int) -> DataFrame:
    return df.withColumn(EDGE, F.lit(0)).unionByName(
        edges.withColumn(EDGE, F.lit(position)), allowMissingColumns=True
    )


def _drop_edges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(F.col(EDGE) == 0).select(*columns)


def fill_last(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    tie: Sequence[str] = (),
    width: int | Depth | None = None,
) -> DataFrame:
    """Replace each of ``cols`` by its last non-NULL value up to and including the row."""
    spanned = with_spans(df, keys, order, width)
    rank = _rank_of(order, tie)
    summary = spanned.groupBy(*keys, SPAN).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in cols]
    )
    before = Window.partitionBy(*keys).orderBy(SPAN).rowsBetween(Window.unboundedPreceding, -1)
    edges = summary.select(
        *keys, SPAN, *[F.last(c, ignorenulls=True).over(before).alias(c) for c in cols]
    )
    upto = (
        Window.partitionBy(*keys, SPAN)
        .orderBy(EDGE, order, *tie)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = _with_edges(spanned, edges, -1).withColumns(
        {c: F.last(c, ignorenulls=True).over(upto) for c in cols}
    )
    return _drop_edges(filled, df.columns)


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: dict[str, str],
    tie: Sequence[str] = (),
    width: int | Depth | None = None,
) -> DataFrame:
    """Add running sums ``{new: source}`` up to and including each row."""
    spanned = with_spans(df, keys, order, width)
    sources = sorted(set(cols.values()))
    summary = spanned.groupBy(*keys, SPAN).agg(*[F.sum(src).alias(src) for src in sources])
    before = Window.partitionBy(*keys).orderBy(SPAN).rowsBetween(Window.unboundedPreceding, -1)
    edges = summary.select(
        *keys, SPAN, *[F.sum(src).over(before).alias(src) for src in sources]
    )
    upto = (
        Window.partitionBy(*keys, SPAN)
        .orderBy(EDGE, order, *tie)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = _with_edges(spanned, edges, -1).withColumns(
        {new: F.sum(src).over(upto) for new, src in cols.items()}
    )
    return _drop_edges(summed, [*df.columns, *cols])


def next_values(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: dict[str, str],
    tie: Sequence[str] = (),
    width: int | Depth | None = None,
) -> DataFrame:
    """Add ``{new: source}`` read from the following row of the key (NULL on the last)."""
    spanned = with_spans(df, keys, order, width)
    rank = _rank_of(order, tie)
    sources = sorted(set(cols.values()))
    summary = spanned.groupBy(*keys, SPAN).agg(
        F.min_by(F.struct(*[F.col(s).alias(f"v{i}") for i, s in enumerate(sources)]), rank).alias(
            "_first"
        )
    )
    spans = Window.partitionBy(*keys).orderBy(SPAN)
    # ``order`` may itself be a source, so the trailing row is rebuilt by name.
    edges = summary.withColumn("_next", F.lead("_first").over(spans)).select(
        *keys, SPAN, *[F.col(f"_next.v{i}").alias(s) for i, s in enumerate(sources)]
    )
    inside = Window.partitionBy(*keys, SPAN).orderBy(EDGE, order, *tie)
    led = _with_edges(spanned, edges, 1).withColumns(
        {new: F.lead(src).over(inside) for new, src in cols.items()}
    )
    return _drop_edges(led, [*df.columns, *cols])
