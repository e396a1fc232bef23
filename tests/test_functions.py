"""Numbers, keys, hex words, addresses."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stakeflow.functions import hexwords as hx, numeric as nm, times
from stakeflow.functions.keccak_address import FIELD, address_from_key, address_of, keccak256
from stakeflow.functions.keys import surrogate_key
from stakeflow.sources.samples import SAMPLE_ADDRESSES, SAMPLE_KEYS
from tests.conftest import wei


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{k} {'double' if isinstance(v, float) or v is None else 'string' if isinstance(v, str) else 'decimal(38,0)'}"
        for k, v in values.items()
    )) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def word(n: int) -> str:
    return f"{n:064x}"


@pytest.mark.parametrize("n", [0, 1, 2**53 + 1, 2**64 - 1, 2**64, 2**96 + 12345, 10**38 - 1])
def test_words_decode_exactly(spark, n):
    assert one(spark, hx.to_number(F.col("w")), w=word(n)) == Decimal(n)


@pytest.mark.parametrize("w", [word(10**38), "f" * 64, "0" * 63 + "g", "", "0" * 63])
def test_words_that_are_not_38_digit_numbers_are_null(spark, w):
    assert one(spark, hx.to_number(F.col("w")), w=w) is None


def test_many_words_decode_exactly(spark):
    numbers = [(i * 7919) ** 7 % 10**38 for i in range(300)]
    df = spark.createDataFrame([(word(n), str(n)) for n in numbers], "w string, n string")
    assert df.filter(hx.to_number(F.col("w")) != F.col("n").cast("decimal(38,0)")).count() == 0


def test_payload_parts(spark):
    key = "02" + "ab" * 32
    payload = "0x" + word(64) + word(160) + word(33) + key.ljust(128, "0") + word(0)
    at = lambda i: hx.to_number(hx.word_at(hx.words(F.col("p")), i))
    assert one(spark, hx.dynamic_bytes(F.col("p"), at(0)), p=payload) == "0x" + key
    assert one(spark, hx.dynamic_bytes(F.col("p"), at(1)), p=payload) is None
    assert one(spark, F.size(hx.words(F.col("p"))), p=payload) == 6
    assert one(spark, hx.word_at(hx.words(F.col("p")), 9), p=payload) is None
    address = "0x" + "1f" * 20
    assert one(spark, hx.to_address(F.lit("0" * 24 + "1f" * 20)), p="x") == address
    assert one(spark, hx.address_word(F.lit("0x00ab")), p="x") == word(0xAB)


def test_keccak_vectors():
    assert keccak256(b"").hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    assert keccak256(b"abc").hex() == "4e03657aea45a94fc7d47ba826c8d667c0d1e6e33a64a036ec44f58fa12d6c45"


def test_known_addresses_and_bad_keys(spark):
    for key, address in zip(SAMPLE_KEYS, SAMPLE_ADDRESSES):
        assert address_of(key) == address_of("0x" + key) == address
    off_curve = "02" + f"{5:064x}"
    for bad in [None, "", "0x", "04" + SAMPLE_KEYS[0][2:], SAMPLE_KEYS[0][:-2], "zz" * 33, off_curve]:
        assert address_of(bad) is None
    df = spark.createDataFrame([(SAMPLE_KEYS[0],), (None,), (off_curve,)], "k string")
    assert [r[0] for r in df.select(address_from_key(F.col("k"))).collect()] == [
        SAMPLE_ADDRESSES[0], None, None
    ]


@settings(max_examples=30, deadline=None)
@given(st.integers(min_value=0, max_value=FIELD - 1))
def test_address_exists_exactly_for_curve_points(x):
    square = (pow(x, 3, FIELD) + 7) % FIELD
    on_curve = square == 0 or pow(square, (FIELD - 1) // 2, FIELD) == 1
    assert (address_of(f"02{x:064x}") is not None) == on_curve


def test_clamp_and_rounding(spark):
    clamp = nm.clamped_tokens(F.col("r"))
    assert one(spark, clamp, r=wei("0.00009")) == 0.0
    assert one(spark, clamp, r=wei("-0.00009")) == 0.0
    assert one(spark, clamp, r=wei("0.0001")) == 0.0001
    assert one(spark, nm.micro(F.col("r")), r=wei("1.0000005")) == wei("1.000001")
    assert one(spark, nm.micro(F.col("r")), r=wei("-1.0000005")) == wei("-1.000001")


def test_null_aware_extremes_and_ratio(spark):
    assert one(spark, nm.strict_extreme(F.greatest, F.col("a"), F.lit(0.0)), a=None) is None
    assert one(spark, nm.strict_extreme(F.greatest, F.col("a"), F.lit(0.0)), a=-3.0) == 0.0
    assert one(spark, nm.ratio("a", "b"), a=1.0, b=0.0) is None


def test_exact_sum_ignores_row_order(spark):
    values = [0.1, 1e15, -1e15, 0.2, 0.3] * 20
    sums = {
        spark.createDataFrame([(v,) for v in order], "v double").agg(nm.exact_sum("v")).first()[0]
        for order in (values, sorted(values), sorted(values, reverse=True))
    }
    assert sums == {12.0}


def test_surrogate_key_keeps_places_of_nulls(spark):
    a = one(spark, surrogate_key(F.lit("x"), F.lit(None)))
    b = one(spark, surrogate_key(F.lit(None), F.lit("x")))
    assert a != b and len(a) == 32


def test_seconds_count_boundaries(spark):
    start, end = dt.datetime(2024, 1, 1, 0, 0, 0, 900_000), dt.datetime(2024, 1, 1, 0, 0, 2, 100_000)
    assert one(spark, times.seconds_between(times.ntz(start), times.ntz(end))) == 2
    assert one(spark, times.days_between(times.ntz(dt.date(2024, 1, 1)), times.ntz(end))) == 0
