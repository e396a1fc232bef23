"""Every registered query equals its SQL on the smallest sample."""

from __future__ import annotations

import pytest

from tests.conftest import SMALL
from verification.compare import compare, connect
from verification.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SMALL, name).startswith("ok")


def test_every_query_has_sql_and_entry_runs(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[0] == "validator_id"
