"""Mix sources to target weights by a min-cost flow.

Documents are summed by membership pattern: the set of sources that may use them. Token
capacity flows from patterns to source quotas. Using a pattern's words once is free, the
second and third time cost ever more, so the flow repeats as little as it can. The flow
decides how many words each pattern gives; documents are then selected by a seeded hash.

Cases: NULL text has size 0; a NULL source is a source of its own, ordered last; repeated
rows share their hash and are taken or left together; documents of size 0 take 0; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window, functions as F

from stakeflow.llm.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
DIGITS = 3  # of the hash: 4096 buckets a pattern; a bucket, not a pattern, is the unit of ordered work
ROUNDS = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weighted_targets(sizes: dict[str | None, int], weights=(1, 2, 3), most: float = 3.0) -> dict[str | None, float]:
    """Share all words among the sources by weight; a share stops at ``most`` times the source's size.

    Weights go round in code point order of the names. What a stopped source cannot take is
    shared again among the others, by weight.
    """
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target: dict[str | None, float] = {}
    left, free = float(sum(sizes.values())), set(names)
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in names if s in free and weight[s] * unit > most * sizes[s]]
        for s in over or free:
            target[s] = float(most * sizes[s]) if over else weight[s] * unit
        left -= sum(target[s] for s in over)
        free -= set(over or free)
    return target


def min_cost_flow(
    capacity: dict[tuple, int], quota: dict[str | None, float], passes: int = 3,
) -> dict[tuple, dict[str | None, float]]:
    """Words that each pattern gives to each of its sources, repeating words as little as possible.

    Costs lie on the arcs out of the origin and rise with the pass, so cheapest paths are
    those that use the lowest pass with room: the flow is augmented pass by pass along
    shortest paths, which may take words back from one source to serve another.
    """
    users: dict = {}
    for pattern in capacity:
        for s in pattern:
            users.setdefault(s, []).append(pattern)
    flow = {p: dict.fromkeys(p, 0.0) for p in capacity}
    need = dict(quota)
    tiny = 1e-6
    for _ in range(passes):
        room = {p: float(c) for p, c in capacity.items()}
        while True:
            # Breadth first from the patterns with room to a source in need.
            came: dict = {("p", p): None for p in room if room[p] > tiny}
            queue, goal = deque(came), None
            while queue and goal is None:
                side, x = node = queue.popleft()
                if side == "p":
                    onward = [("s", s) for s in x if s in need]
                elif need[x] > tiny:
                    goal = node
                    break
                else:
                    onward = [("p", p) for p in users[x] if flow[p][x] > tiny]
                for y in onward:
                    if y not in came:
                        came[y] = node
                        queue.append(y)
            if goal is None:
                break
            path = [goal]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            back = [flow[b[1]][a[1]] for a, b in zip(path, path[1:]) if a[0] == "s"]
            amount = min([room[path[0][1]], need[goal[1]], *back])
            room[path[0][1]] -= amount
            need[goal[1]] -= amount
            for a, b in zip(path, path[1:]):
                if a[0] == "p":
                    flow[a[1]][b[1]] += amount
                else:
                    flow[b[1]][a[1]] -= amount
    return flow


def _select(rows: DataFrame, budget: dict[str, float]) -> DataFrame:
    """Rows in seeded order while their running size stays within the budget of their pattern.

    The order of a pattern is cut into buckets by the first digits of the hash. Sums of
    buckets give each one its starting point, so no task holds a whole pattern.
    """
    per_pattern = rows.sparkSession.createDataFrame(
        [(k, float(v)) for k, v in budget.items()], "pattern string, budget double"
    )
    fit = rows.join(F.broadcast(per_pattern), "pattern").filter(
        (F.col("size") > 0) & (F.col("size") <= F.col("budget"))
    )
    sums = fit.groupBy("pattern", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.select(
        "pattern", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("start")
    )
    inner = Window.partitionBy("pattern", "bucket").orderBy("hash")
    reach = F.col("start") + F.sum("size").over(inner)
    return fit.join(start, ["pattern", "bucket"]).withColumn("reach", reach).filter(
        F.col("reach") <= F.col("budget")
    ).select("pattern", "hash", "size")


def mix(
    docs: DataFrame, members: Column | None = None, text: str = "text", seed: int = 17,
    weights=(1, 2, 3), most: int = 3, patterns_limit: int = 100_000,
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target and the words taken, repeats counted.

    ``members``: array of the sources that may use a document; its own source by default. A
    pattern gives whole passes over its documents; what remains goes to documents in seeded
    order that fit, in a few rounds, so that a long document at the edge is passed over for
    shorter ones. Patterns and sources, not documents, reach the driver: a table of more than
    ``patterns_limit`` patterns is refused. Reruns agree.
    """
    spark = docs.sparkSession
    own = docs["source"]
    listed = F.array(own) if members is None else members
    rows = docs.select(
        "doc_id", "source", word_count(docs[text]).alias("size"),
        F.to_json(F.struct(F.array_sort(F.array_distinct(listed)).alias("m")), {"ignoreNullFields": "false"}).alias("pattern"),
        F.array_sort(F.array_distinct(listed)).alias("members"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs["doc_id"].cast("string"), F.lit("")))).alias("hash"),
    )
    rows = written(rows.withColumn("bucket", F.substring("hash", 1, DIGITS)), "mix")
    by_pattern = rows.groupBy("pattern", "source").agg(
        F.sum("size").alias("words"), F.first("members").alias("members")
    ).limit(patterns_limit + 1).collect()
    if len(by_pattern) > patterns_limit:
        raise ValueError(f"more than {patterns_limit} membership patterns")
    sizes: dict = {}
    capacity: dict = {}
    names: dict = {}
    for r in by_pattern:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["words"]
        key = tuple(r["members"])
        names[key] = r["pattern"]
        capacity[key] = capacity.get(key, 0) + r["words"]
    for key in capacity:
        for s in key:
            sizes.setdefault(s, 0)
    target = weighted_targets(sizes, weights, most)
    given = {k: sum(f.values()) for k, f in min_cost_flow(capacity, target, most).items()}
    whole = {names[k]: min(most, int(given[k] / c + 1e-9)) if c else 0 for k, c in capacity.items()}
    left = {names[k]: max(0.0, given[k] - whole[names[k]] * c) for k, c in capacity.items()}
    left = {p: round(v, 3) for p, v in left.items()}
    passes = _lookup(spark, [(p, n) for p, n in whole.items()], "pattern string, passes int")
    chosen = None
    rest = rows.select("pattern", "bucket", "hash", "size")
    for _ in range(ROUNDS):
        more = written(_select(rest, left), "mix-part")
        for r in more.groupBy("pattern").agg(F.sum("size").alias("words")).collect():
            left[r["pattern"]] -= r["words"]
        chosen = more if chosen is None else chosen.unionByName(more)
        rest = rest.join(more.select("pattern", "hash").distinct(), ["pattern", "hash"], "left_anti")
    extra = chosen.select("pattern", "hash").distinct().withColumn("extra", F.lit(1))
    goals = _lookup(spark, [(s, sizes[s], target[s]) for s in sizes], "goal_source string, source_size long, target double")
    return rows.join(F.broadcast(passes), "pattern").join(extra, ["pattern", "hash"], "left").join(
        F.broadcast(goals), F.col("source").eqNullSafe(F.col("goal_source"))
    ).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * (F.col("passes") + F.coalesce("extra", F.lit(0)))).cast("long").alias("taken"),
    )


def _lookup(spark, values: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(values, schema)
