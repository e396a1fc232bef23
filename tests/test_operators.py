"""Generic operators against hand-written rows and plain-window forms."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from stakeflow import operators as ops
from tests.conftest import day, rows, same, ts


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds more than a third of the rows; another is NULL."""
    rng = random.Random(5)
    data = []
    for i in range(1500):
        key = "hot" if i % 5 < 2 else None if i % 5 == 2 else f"k{rng.randrange(40)}"
        data.append((i, key, rng.choice("abc"), float(rng.randrange(100)) if i % 3 else None))
    return spark.createDataFrame(data, "n bigint, key string, value string, x double").repartition(7)


UP = lambda *k: Window.partitionBy(*k).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)


@pytest.mark.parametrize("width", [1, 37, 10_000])
def test_scans_equal_plain_windows(skewed, width):
    plain = Window.partitionBy("key").orderBy("n")
    same(
        ops.fill_last(skewed, ["key"], "n", ["x"], width=width),
        skewed.withColumn("x", F.last("x", True).over(UP("key"))),
    )
    same(
        ops.prefix_sums(skewed, ["key"], "n", {"s": "x"}, width=width),
        skewed.withColumn("s", F.sum("x").over(UP("key"))),
    )
    same(
        ops.next_values(skewed, ["key"], "n", {"m": "n", "v": "value"}, width=width),
        skewed.withColumns({"m": F.lead("n").over(plain), "v": F.lead("value").over(plain)}),
    )
    same(
        ops.next_values(skewed, [], "n", {"m": "n"}, width=width),
        skewed.withColumn("m", F.lead("n").over(Window.orderBy("n"))),
    )


@pytest.mark.parametrize("block", [30, 100, 100_000])
def test_rolling_means_equal_plain_frames(skewed, block):
    frame = lambda n: Window.partitionBy("key").orderBy("n").rowsBetween(1 - n, 0)
    same(
        ops.rolling_mean_rows(
            skewed, ["key"], "n", "x", {"a": 7, "b": 30}, block=block, width=50
        ),
        skewed.withColumns({"a": F.avg("x").over(frame(7)), "b": F.avg("x").over(frame(30))}),
    )


@pytest.mark.parametrize("width", [1, 53, 10_000])
def test_islands_equal_plain_form(skewed, width):
    df = skewed.withColumn("t", F.lit(ts("01")))
    w = Window.partitionBy("key").orderBy("n")
    marked = df.withColumn("c", (~F.col("value").eqNullSafe(F.lag("value").over(w))).cast("int"))
    marked = marked.withColumn("g", F.sum("c").over(UP("key")))
    ranges = marked.groupBy("key", "value", "g").agg(
        F.min("n").alias("start"), F.max("n").alias("end"), F.count("*").alias("n")
    )
    g = Window.partitionBy("key").orderBy("g")
    expected = ranges.select(
        "key", "value", "start", "end", "n", F.lead("value").over(g).alias("next_value"),
        F.lead("value").over(g).isNull().alias("is_current"),
    )
    found = ops.islands(df, "key", "n", "value", "t", width=width).drop("start_ts", "end_ts")
    same(found, expected)


def test_islands_do_not_bridge_other_values(spark):
    df = spark.createDataFrame(
        [(1, n, v, ts("01")) for n, v in enumerate("aabaaacc")], "k int, n bigint, v string, t timestamp_ntz"
    )
    for width in (1, 2, 3, 4, 100):
        found = rows(ops.islands(df, "k", "n", "v", "t", width=width), "start")
        assert [(r["v"], r["start"], r["end"], r["n"]) for r in found] == [
            ("a", 0, 1, 2), ("b", 2, 2, 1), ("a", 3, 5, 3), ("c", 6, 7, 2)
        ]
        assert [r["is_current"] for r in found] == [False, False, False, True]


def asof_frames(spark):
    left = spark.createDataFrame(
        [(1, "k", ts("01T10:00:00")), (2, "k", ts("01T12:00:00")), (3, "k", ts("05T00:00:00")),
         (4, "z", ts("05T00:00:00")), (5, None, ts("05T00:00:00"))],
        "id int, key string, at timestamp_ntz",
    )
    right = spark.createDataFrame(
        [(10, "k", ts("01T10:00:00"), 1), (11, "k", ts("02T00:00:00"), 1),
         (12, "k", ts("02T00:00:00"), 2), (13, None, ts("01T00:00:00"), 1)],
        "rid int, key string, at timestamp_ntz, seq int",
    )
    return left, right


def test_asof_ties_reuse_and_nulls(spark):
    left, right = asof_frames(spark)
    strict = ops.asof_join(left, right, ["key"], "at", "at", {"rid": "rid"}, right_tie=["seq"])
    assert {r["id"]: r["rid"] for r in rows(strict)} == {1: None, 2: 10, 3: 12, 4: None, 5: None}
    loose = ops.asof_join(
        left, right, ["key"], "at", "at", {"rid": "rid"}, strict=False, right_tie=["seq"]
    )
    assert {r["id"]: r["rid"] for r in rows(loose)} == {1: 10, 2: 10, 3: 12, 4: None, 5: None}


def test_asof_equals_join_and_rank(skewed):
    left = skewed.filter("n % 2 = 0").select("n", "key", "value")
    right = skewed.filter("n % 2 = 1").select(F.col("n").alias("m"), F.col("key").alias("rk"))
    ranked = left.join(right, (left.key == right.rk) & (right.m < left.n), "left").groupBy(
        "n", "key", "value"
    ).agg(F.max("m").alias("m"))
    for width in (1, 40, 10_000):
        same(
            ops.asof_join(left, right.withColumnRenamed("rk", "key"), ["key"], "n", "m", {"m": "m"}, width=width),
            ranked,
        )


def test_densify_fill_and_hold_agree(spark):
    df = spark.createDataFrame(
        [("a", day(2), 5), ("a", day(5), 7), ("b", day(4), 1)], "k string, d date, v int"
    )
    dense = ops.densify(df, ["k"], "d", day(6))
    filled = ops.forward_fill(dense, ["k"], "d", ["v"]).withColumnRenamed("is_forward_filled", "is_repeated")
    same(filled, ops.hold_until_next(df, ["k"], "d", day(6)))
    assert dense.count() == 5 + 3 and dense.filter("v is null").count() == 5


def test_hold_zeroes_changes_and_drops_runs(spark):
    df = spark.createDataFrame(
        [("a", day(1), 5.0, 5.0), ("a", day(3), 0.0, -5.0)], "k string, d date, balance double, change double"
    )
    held = ops.hold_until_next(df, ["k"], "d", day(9), ["change"], F.col("balance") == 0)
    assert [(r["d"].day, r["balance"], r["change"]) for r in rows(held, "d")] == [
        (1, 5.0, 5.0), (2, 5.0, 0.0), (3, 0.0, -5.0)
    ]


def test_running_balance_seed_and_clamp(spark):
    unit = Decimal(10**14)  # 0.0001 tokens
    df = spark.createDataFrame(
        [("a", 1, 10 * unit), ("a", 2, -10 * unit + 60), ("b", 1, unit)], "k string, n bigint, raw decimal(38,0)"
    )
    seed = spark.createDataFrame([("b", 4 * unit)], "k string, balance decimal(38,0)")
    out = rows(ops.running_balance(df, ["k"], "n", {"balance": "raw"}, seed=seed), "k", "n")
    assert [r["balance"] for r in out] == [0.001, 0.0, 0.0005]


def test_latest_daily_outer_and_expectation(spark):
    df = spark.createDataFrame(
        [("a", ts("01T01:00:00"), 1.0), ("a", ts("01T05:00:00"), 2.0), ("b", ts("02T01:00:00"), 3.0)],
        "k string, t timestamp_ntz, v double",
    )
    assert {r["k"]: r["v"] for r in rows(ops.latest_per_key(df, ["k"], "t"))} == {"a": 2.0, "b": 3.0}
    assert {r["price_date"].day: r["v"] for r in rows(ops.daily_last(df, "t", "v"))} == {1: 2.0, 2: 3.0}
    left = spark.createDataFrame([(1, 5)], "k int, a bigint")
    right = spark.createDataFrame([(2, 6)], "k int, b bigint")
    both = rows(ops.full_outer_measures(left, right, ["k"], ["a", "b"]), "k")
    assert both == [{"k": 1, "a": 5, "b": 0}, {"k": 2, "a": 0, "b": 6}]
    zero = spark.createDataFrame([("g", 0.0, 10)], "g string, w double, n int")
    only = rows(ops.weighted_expectation(zero, ["g"], "w", "n"))[0]
    assert only["weight_share"] is None and only["expected"] is None


def test_depth_spans_split_a_burst_evenly(spark):
    """All rows of one key inside one hour: fixed spans give one task, depth spans about equal ones."""
    from stakeflow.operators import ordered

    burst = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("key"),
        (F.lit("2024-01-05 10:00:00").cast("timestamp_ntz") + F.make_interval(secs=(F.col("id") % 3000) / 1000)).alias("t"),
        F.col("id").alias("n"), (F.col("id") % 13).cast("double").alias("x"),
    )
    assert burst.select(ordered.span_of(burst, "t").alias("s")).filter("key = 'hot'").distinct().count() <= 1
    spanned = ordered.depth_spans(burst, ["key"], "t", rows=500)
    sizes = sorted(r["c"] for r in spanned.filter("key = 'hot'").groupBy(ordered.SPAN).agg(F.count("*").alias("c")).collect())
    assert len(sizes) >= 16 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    # Equal values share a span.
    assert spanned.groupBy("key", "t").agg(F.countDistinct(ordered.SPAN).alias("d")).filter("d > 1").count() == 0
    plain = Window.partitionBy("key").orderBy("t", "n").rowsBetween(Window.unboundedPreceding, 0)
    same(
        ops.prefix_sums(burst, ["key"], "t", {"s": "x"}, tie=["n"], width=ordered.Depth(500)),
        burst.withColumn("s", F.sum("x").over(plain)),
    )
    same(
        ops.fill_last(burst.withColumn("x", F.when(F.col("n") % 4 == 0, F.col("x"))), ["key"], "t", ["x"], tie=["n"], width=ordered.Depth(500)),
        burst.withColumn("x", F.last(F.when(F.col("n") % 4 == 0, F.col("x")), ignorenulls=True).over(plain)),
    )


@pytest.mark.parametrize("column", ["n", "value"])
def test_depth_spans_on_the_skewed_table(skewed, column):
    from stakeflow.operators import ordered

    if column == "value":
        with pytest.raises(TypeError):
            ordered.depth_spans(skewed, ["key"], column, rows=50)
        return
    same(
        ops.islands(skewed.withColumn("t", F.col("n")), "key", "n", "value", "t", width=ordered.Depth(50)),
        ops.islands(skewed.withColumn("t", F.col("n")), "key", "n", "value", "t", width=10_000),
    )
    same(
        ops.prefix_sums(skewed, ["key"], "n", {"s": "x"}, width=ordered.Depth(50)),
        skewed.withColumn("s", F.sum("x").over(UP("key"))),
    )
    same(
        ops.next_values(skewed, ["key"], "n", {"m": "n", "v": "value"}, width=ordered.Depth(50)),
        skewed.withColumns({"m": F.lead("n").over(Window.partitionBy("key").orderBy("n")),
                            "v": F.lead("value").over(Window.partitionBy("key").orderBy("n"))}),
    )
