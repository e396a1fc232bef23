from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from stakeflow.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("stakeflow-tests", memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def chain(spark):
    from verification.registry import chain

    return chain(spark, SMALL)


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(f"2024-01-{text}")


def day(n: int) -> dt.date:
    return dt.date(2024, 1, n)


def wei(tokens: str) -> Decimal:
    return Decimal(tokens) * 10**18


def rows(df, *order):
    """Rows as a sorted list of dicts."""
    found = [r.asDict(recursive=True) for r in df.collect()]
    keys = order or df.columns
    return sorted(found, key=lambda r: tuple((r[k] is None, str(r[k])) for k in keys))


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a = sorted((tuple(r) for r in left.select(*columns).collect()), key=str)
    b = sorted((tuple(r) for r in right.select(*columns).collect()), key=str)
    assert a == b
