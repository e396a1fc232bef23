"""Near-duplicate documents by one-permutation MinHash.

Each document's shingles are hashed once. The hash space is cut into bins, the least hash of each
bin is kept, and empty bins borrow from others by optimal densification. Bands of the signature
are buckets. A bucket proposes a star: links from its centre to its members, never all pairs. Links
are confirmed on the full sets of shingles.

A star can miss a link between two members that are both too far from the centre. So wherever a group of
documents joined by proposals falls into several components, its smaller components are compared with
the whole group, in blocks of bounded size and only for sizes that can reach the threshold. With 32
bands of 4 a pair at 0.85 shares no band with probability 5e-11.

Documents with equal sets are one class throughout and never expand into pairs.

Cases: NULL, empty and blank texts have no shingles and are linked with nothing; rows that share a doc_id
are one document; a row with NULL doc_id is returned with NULL component_id and kept false; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stakeflow.llm.components import components
from stakeflow.llm.scratch import small_batches, written
from stakeflow.llm.wordhash import Words, mix, shingles, slices, split

BINS = 128
ROWS = 4
BANDS = BINS // ROWS
BLOCK = 256
SMALL = 1_000_000  # ids that may be broadcast, some tens of MB at most
SKETCH = "id long, n_shingles long, mark long, bands array<long>"


def densified(least: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """Fill empty bins from random full ones: bin j tries bins f(j, 1), f(j, 2), ... until one is full.

    The choices depend on the bin and the attempt alone, so equal sets agree in every bin.
    """
    out, rows, bins = least.copy(), *np.nonzero(empty)
    attempt = 0
    while len(rows):
        attempt += 1
        pick = (mix(bins.astype(np.uint64) * np.uint64(0x1000003) + np.uint64(attempt)) >> np.uint64(57)).astype(np.int64)
        full = ~empty[rows, pick]
        out[rows[full], bins[full]] = least[rows[full], pick[full]]
        rows, bins = rows[~full], bins[~full]
    return out


def mark(items: np.ndarray) -> np.uint64:
    """A hash of a whole set."""
    return mix(mix(items).sum(keepdims=True) ^ np.uint64(len(items)))[0]


def sketches(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set sizes, a hash of each whole set, band keys) of consecutive documents."""
    n = len(first) - 1
    sizes, marks = np.zeros(n, np.int64), np.zeros(n, np.uint64)
    least, empty = np.zeros((n, BINS), np.uint64), np.ones((n, BINS), bool)
    for d in range(n):
        own = np.sort(hashes[first[d]:first[d + 1]])
        if not len(own):
            continue
        own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        sizes[d] = len(own)
        marks[d] = mark(own)
        bins = (own >> np.uint64(57)).astype(np.int64)
        lead = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        least[d, bins[lead]] = own[lead]  # sorted, so the first of a bin is its least
        empty[d, bins[lead]] = False
    some = np.flatnonzero(sizes)
    filled = densified(least[some], empty[some]).reshape(len(some), BANDS, ROWS)
    keys = np.zeros((n, BANDS), np.uint64)
    band = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    key = np.broadcast_to(band, (len(some), BANDS))
    for r in range(ROWS):
        key = mix(key * np.uint64(31) + filled[:, :, r])
    keys[some] = key
    return sizes, marks, keys


def _sketch_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, offsets in slices(batch.column(1)):
                h, first = shingles(split(data, offsets), k)
                sizes, marks, keys = sketches(h, first)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)),
                    pa.array(keys[sizes > 0].ravel().view(np.int64)),
                )
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a), pa.array(sizes), pa.array(marks.view(np.int64)), bands,
                ], ["id", "n_shingles", "mark", "bands"])

    return run


def _set_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                h, first = shingles(split(data, offsets), k)
                own = [np.unique(h[first[d]:first[d + 1]]) for d in range(b - a)]
                marks = np.array([mark(x) for x in own], np.uint64).view(np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)),
                    pa.array(np.concatenate(own).view(np.int64)),
                )
                yield pa.RecordBatch.from_arrays([pa.array(marks), lists], ["mark", "items"])

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every left set with every right one, in memory bounded by ``width``.

    Only items found on both sides count. They are taken ``width`` at a time as columns of 0/1
    matrices whose product has the sizes.
    """
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)

    def placed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        items = np.concatenate(sets)
        at = np.searchsorted(both, items)
        known = (at < len(both)) & (both[np.minimum(at, len(both) - 1)] == items)
        order = np.argsort(at[known], kind="stable")
        return owner[known][order], at[known][order]

    if not len(both):
        return out.astype(np.int64)
    sides = [(placed(x), len(x)) for x in (left, right)]
    for low in range(0, len(both), width):
        part = []
        for (owner, at), n in sides:
            a, b = np.searchsorted(at, [low, low + width])
            dense = np.zeros((n, width), np.float32)
            dense[owner[a:b], at[a:b] - low] = 1
            part.append(dense)
        out += part[0] @ part[1].T
    return out.astype(np.int64)


def _links_between(least: int, of: int):
    """Spanning links between the components of a block of small components and a block of their group."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        small, other = block[block["small"]], block[~block["small"]]
        if not len(small) or not len(other):
            return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        common = overlaps(list(small["items"]), list(other["items"]))
        a, b = small["items"].map(len).to_numpy(), other["items"].map(len).to_numpy()
        near = of * common >= least * (a[:, None] + b[None, :] - common)
        x, y = small["component"].to_numpy(), other["component"].to_numpy()
        i, j = np.nonzero(near & (x[:, None] != y[None, :]))
        return pd.DataFrame({"u": x[i], "v": y[j]}).drop_duplicates()

    return run


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, least: int = 80, of: int = 100,
) -> DataFrame:
    """(id, n_shingles, component_id): links where of * |intersection| >= least * |union| of k-word shingles."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    # Whole texts reach Python in small batches, so that its workers and the Arrow buffers of the JVM stay small.
    with small_batches(docs.sparkSession):
        sketch = written(rows.mapInArrow(_sketch_batches(k), SKETCH), "sketch")
    filled = sketch.filter("n_shingles > 0 AND id IS NOT NULL")
    classes = written(filled.groupBy("mark").agg(
        F.min("id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
    ), "classes")
    keys = classes.select("mark", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    counted = keys.groupBy("band", "bucket").agg(F.count("*").alias("members")).filter("members > 1")
    shared = written(keys.join(counted, ["band", "bucket"]), "buckets")
    # The centre is the member that meets most others over all bands: in a group of edited copies, their source.
    rank = shared.groupBy("mark").agg(F.sum("members").alias("met"))
    centres = shared.join(rank, "mark").groupBy("band", "bucket").agg(
        F.max(F.struct("met", "mark", "n_shingles")).alias("c")
    ).select("band", "bucket", F.col("c.mark").alias("centre"), F.col("c.n_shingles").alias("centre_size"))
    proposed = written(shared.join(centres, ["band", "bucket"]).filter("mark <> centre").select(
        F.col("mark").alias("u"), F.col("centre").alias("v"), "n_shingles", "centre_size",
    ).distinct(), "proposed")
    met = written(
        proposed.select(F.col("u").alias("mark")).unionByName(proposed.select(F.col("v").alias("mark"))).distinct(), "met"
    )
    wanted = written(classes.join(met, "mark").select(F.col("rep").alias("id")).distinct(), "wanted")
    with small_batches(docs.sparkSession):
        sets = written(
            small_or_shuffled(rows, wanted, "id", wanted.count()).select("id", "text").mapInArrow(
                _set_batches(k), "mark long, items array<long>"
            ).join(met, "mark", "left_semi").dropDuplicates(["mark"]), "sets",
        )
    can_reach = f"{of} * least(n_shingles, centre_size) >= {least} * greatest(n_shingles, centre_size)"
    links = confirmed(proposed.filter(can_reach), sets, least, of)
    label = components(links).withColumnRenamed("id", "mark")
    more = rest_of_groups(proposed, met, label, sets, least, of)
    # Rows of one document tie its classes together.
    several = filled.groupBy("id").agg(F.min("mark").alias("u"), F.max("mark").alias("v")).filter("u <> v")
    knots = filled.select("id", F.col("mark").alias("v")).join(several.select("id", "u"), "id").select("u", "v")
    more = written(knots if more is None else more.unionByName(knots), "more")
    if not more.isEmpty():
        stars = label.select(F.col("mark").alias("u"), F.col("component").alias("v"))
        label = components(stars.unionByName(more)).withColumnRenamed("id", "mark")
    named = written(classes.select("mark", "rep").join(label, "mark"), "named")
    least_id = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    class_of = named.join(least_id, "component").select("mark", "component_id").unionByName(
        classes.join(label, "mark", "left_anti").select("mark", F.col("rep").alias("component_id"))
    )
    return filled.select("id", "n_shingles", "mark").join(class_of, "mark").select(
        "id", "n_shingles", "component_id"
    ).unionByName(sketch.filter("n_shingles = 0 OR id IS NULL").select(
        "id", "n_shingles", F.col("id").alias("component_id")
    ))


def small_or_shuffled(rows: DataFrame, wanted: DataFrame, key: str, ids: int) -> DataFrame:
    """``rows`` joined with the few ``wanted`` ones: broadcast up to ``SMALL`` ids, or else a plain join."""
    return rows.join(F.broadcast(wanted) if ids <= SMALL else wanted, key)


def confirmed(proposed: DataFrame, sets: DataFrame, least: int, of: int) -> DataFrame:
    """The proposed links (u, v) whose full sets are similar enough."""
    pairs = proposed.select("u", "v").join(
        sets.select(F.col("mark").alias("u"), F.col("items").alias("x")), "u"
    ).join(sets.select(F.col("mark").alias("v"), F.col("items").alias("y")), "v")
    common = F.size(F.array_intersect("x", "y"))
    return written(pairs.select("u", "v", common.alias("c"), (F.size("x") + F.size("y")).alias("total")).filter(
        F.col("c") * of >= (F.col("total") - F.col("c")) * least
    ).select("u", "v"), "near")


def rest_of_groups(
    proposed: DataFrame, met: DataFrame, found: DataFrame, sets: DataFrame, least: int, of: int,
) -> DataFrame | None:
    """Links between components of one group of proposals that no star has joined."""
    label = written(met.join(found, "mark", "left").select(
        "mark", F.coalesce("component", "mark").alias("component")
    ), "label")
    # Groups of components that proposals run between.
    ends = proposed.select("u", "v").join(label.select(F.col("mark").alias("u"), F.col("component").alias("x")), "u").join(
        label.select(F.col("mark").alias("v"), F.col("component").alias("y")), "v"
    )
    between = written(ends.filter("x <> y").select(F.col("x").alias("u"), F.col("y").alias("v")).distinct(), "between")
    if between.isEmpty():
        return None
    groups = components(between).select(F.col("id").alias("component"), F.col("component").alias("grp"))
    member = written(label.join(groups, "component"), "grouped")
    by_part = member.groupBy("grp", "component").agg(F.count("*").alias("n"))
    main = by_part.groupBy("grp").agg(
        F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("all")
    ).filter("all > 2").select("grp", F.col("m.component").alias("main"))
    step = math.log(of / least)
    rows = written(member.join(main, "grp").join(sets, "mark").select(
        "grp", "mark", "component", "items", (F.col("component") != F.col("main")).alias("small"),
        F.floor(F.log(F.size("items").cast("double")) / step).cast("int").alias("level"),
    ), "rest")
    if rows.isEmpty():
        return None
    # Sets whose sizes can reach the threshold lie in the same or in adjoining levels.
    counts = written(rows.groupBy("grp", "level").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count(F.when(F.col("small"), 1)) / BLOCK).cast("int").alias("small_blocks"),
    ), "blocks")
    near = lambda c: F.explode(F.array(c - 1, c, c + 1))
    spread = lambda c: F.pmod(F.xxhash64("mark"), c).cast("int")
    # Every block meets every small block of the levels around it.
    others = rows.join(counts, ["grp", "level"]).select(
        "grp", "mark", "component", "items", F.lit(False).alias("small"), F.col("level").alias("to"),
        spread(F.col("blocks")).alias("block"), near(F.col("level")).alias("level"),
    ).join(counts.select("grp", "level", "small_blocks"), ["grp", "level"]).filter("small_blocks > 0").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("small_blocks") - 1)).alias("small_block")
    )
    few = rows.filter("small").join(counts, ["grp", "level"]).select(
        "grp", "mark", "component", "items", F.lit(True).alias("small"), "level",
        spread(F.col("small_blocks")).alias("small_block"), near(F.col("level")).alias("to"),
    ).join(counts.select("grp", F.col("level").alias("to"), "blocks"), ["grp", "to"]).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )
    columns = ["grp", "level", "to", "block", "small_block", "component", "items", "small"]
    return others.select(*columns).unionByName(few.select(*columns)).groupBy(*columns[:5]).applyInPandas(
        _links_between(least, of), "u long, v long"
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def keep_one(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with only the smallest id of each component; rows without an id stay."""
    dropped = found.filter("id <> component_id").select(F.col("id").alias(key)).distinct()
    return docs.join(dropped, key, "left_anti")
