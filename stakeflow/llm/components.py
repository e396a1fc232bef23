"""Connected components of links by alternating large-star and small-star steps.

Both steps keep the components and end in stars whose centre is the smallest id. A vertex with
very many links is summed in a hash aggregate and its links are rejoined by a plain join,
which adaptive execution can split, so no group is held by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stakeflow.llm.scratch import written


def _both(links: DataFrame) -> DataFrame:
    return links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large(links: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked with the smallest id among u and its neighbours."""
    both = _both(links)
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked with the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        low.select("u", F.col("m").alias("v"))
    )


def _settled(links: DataFrame) -> bool:
    """Whether all links are arms of stars: every u has one v, which is smaller and no u itself."""
    ends = links.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("in"), F.expr("int(v > u)").alias("up"))
    ends = ends.unionByName(links.select(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("in"), F.lit(0).alias("up")))
    odd = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("in").alias("in"), F.max("up").alias("up"))
    return odd.filter("out > 1 OR (out = 1 AND in = 1) OR up = 1").isEmpty()


def components(links: DataFrame, most_rounds: int = 60, stored: bool = False) -> DataFrame:
    """(id, component): each linked id with the smallest id it can reach.

    ``links`` has two integer columns u and v; loops and repeats do no harm. ``stored`` ones, a written table
    without repeats, are not written again. Each round is a
    written table. An error is raised if the stars have not settled after ``most_rounds``, which
    the logarithmic bound of the method rules out for any table that fits on a disk.
    """
    tidy = lambda df: df.filter("u <> v").distinct()
    now = links.filter("u <> v") if stored else written(tidy(links), "links")
    for _ in range(most_rounds):
        if _settled(now):
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        now = written(tidy(_small(tidy(_large(now)))), "links")
    raise RuntimeError("components did not settle")
