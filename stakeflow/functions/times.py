"""Date and time differences with boundary-count semantics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

EPOCH = dt.datetime(1970, 1, 1)


def whole_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp."""
    return (
        F.datediff(F.to_date(ts), F.lit(dt.date(1970, 1, 1))).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end."""
    return whole_seconds(end) - whole_seconds(start)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


def as_timestamp(as_of: dt.date | dt.datetime) -> dt.datetime:
    if isinstance(as_of, dt.datetime):
        return as_of
    return dt.datetime.combine(as_of, dt.time())


def ntz(value: dt.date | dt.datetime) -> Column:
    return F.lit(as_timestamp(value).isoformat(sep=" ")).cast("timestamp_ntz")
