"""Passages that repeat across documents, by MinHash bands over content-defined paragraphs and whole lines.

Line breaks do not mark passages that were pasted into running text, so paragraphs are cut by
content: of every ``PARAGRAPH`` consecutive five-word shingles the one with the least hash starts a
paragraph of ``PARAGRAPH`` words. Two texts that share a run of 2 * PARAGRAPH - 1 = 51 words share one such
paragraph whole, wherever the run begins. An edit inside such a paragraph leaves it under the threshold, so whole
lines of PARAGRAPH words or more are pieces as well, and so are shorter neighbouring lines, joined.

Each piece's shingles give a short MinHash signature, whose bands are buckets. Pieces joined by buckets are a group.
Pieces of equal words are one class; links between different classes of a group are verified by the exact Jaccard
similarity of their shingles. Components of classes are clusters. The first document of a cluster keeps the
passage, the others lose it.

Most buckets hold overlapping pieces of one document. So each document first joins its own pieces into knots, in the
task that reads it, and only the distinct bands of its knots are shuffled. A group that lies in one document repeats
nothing and ends there, before any shingles are sent. Of knots with equal pieces one sends its shingles. A group of up to
GROUP shingles is compared in the task that gets it, several groups of no more shingles in all at a time. Larger groups are dealt out by the
shingles that similar sets must share, and what is too large even so is compared in blocks. Every way finds the
components of all links in a group.

Bands are tuned for recall: eight bands of two rows find a line at similarity 0.8 with probability 0.9997. Three bands
find a paragraph at 0.8 with probability 0.95, an equal one always. An edited passage that is part of a longer
line on both sides has only its paragraphs.

Cases: NULL, empty and blank texts and texts of fewer than PARAGRAPH words have no paragraphs; a passage repeated
only within one document is not reported; rows that share a doc_id are one document; rows with NULL doc_id take no part; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stakeflow.llm.components import components
from stakeflow.llm.near_dups import confirmed, rest_of_groups, small_or_shuffled
from stakeflow.llm.scratch import small_batches, written
from stakeflow.llm.wordhash import Words, mix, runs, slices, split

PARAGRAPH = 26
SHINGLE = 5
BANDS, LINE_BANDS, ROWS = 3, 8, 2
GROUP = 1 << 21  # shingles of the classes that one task compares at a time
CHUNK = 1 << 20  # shingles or pairs of classes that are compared at once
BATCH = 1 << 24  # bytes of texts or shingles that reach Python at a time; a single longer row comes alone
_SEEDS = mix(np.arange(1, LINE_BANDS * ROWS + 1, dtype=np.uint64))


def paragraph_starts(words: Words, grams: np.ndarray, size: int = PARAGRAPH) -> np.ndarray:
    """Word indexes at which a paragraph starts: the least shingle of every ``size`` possible starts in a row."""
    count = np.maximum(0, np.diff(words.first) - size + 1)  # places where a whole paragraph fits
    place = np.arange(count.sum())
    doc = np.repeat(np.arange(len(count)), count)
    base = np.concatenate([[0], np.cumsum(count)])
    at = words.first[:-1][doc] + place - base[:-1][doc]
    if not len(at):
        return at
    value = grams[at]
    chosen = np.zeros(len(at), bool)
    if len(at) >= size:
        whole = np.flatnonzero(doc[:len(at) - size + 1] == doc[size - 1:])
        for low in range(0, len(whole), 1 << 16):
            own = whole[low:low + (1 << 16)]
            view = np.lib.stride_tricks.sliding_window_view(value, size)[own]
            chosen[own + view.argmin(axis=1)] = True
    for d in np.flatnonzero((count > 0) & (count < size)):
        chosen[base[d] + int(value[base[d]:base[d + 1]].argmin())] = True
    return at[chosen]


def line_units(words: Words, size: int = PARAGRAPH) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of each line of ``size`` words or more, and of shorter neighbours joined.

    From every shorter line, the lines up to the next long one are joined until they have ``size`` words, and again
    until they have twice as many, so that the joined lines of a passage do not depend on the lines before it.
    """
    if not len(words.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = np.searchsorted(np.flatnonzero(words.data == 10), words.start)
    fresh = (line[1:] != line[:-1]) | (words.doc[1:] != words.doc[:-1])
    lead = np.flatnonzero(np.concatenate([[True], fresh]))
    edge = np.append(lead, len(words.start))
    count = np.diff(edge)
    long = count >= size
    starts, sizes = [lead[long]], [count[long]]
    # Where the run of short lines that a line lies in ends.
    short = np.flatnonzero(~long)
    doc = words.doc[lead]
    stop = np.flatnonzero(np.concatenate([long[1:] | (doc[1:] != doc[:-1]), [True]]))
    last = edge[stop[np.searchsorted(stop, short)] + 1]
    for least in (size, 2 * size):
        to = edge[np.minimum(np.searchsorted(edge, lead[short] + least), len(edge) - 1)]
        fit = (to <= last) & (to - lead[short] >= least)
        starts.append(lead[short[fit]])
        sizes.append(to[fit] - lead[short[fit]])
    return np.concatenate(starts), np.concatenate(sizes)


class Pieces(NamedTuple):
    """Pieces of one slice: its paragraphs, then its lines. The shingles of piece i are ``own[edges[i]:edges[i + 1]]``."""

    ids: np.ndarray  # doc_id of each row of the slice
    doc: np.ndarray  # row of each piece
    start: np.ndarray
    size: np.ndarray
    own: np.ndarray
    edges: np.ndarray
    exact: np.ndarray  # hash of the words
    keys: np.ndarray  # one column per band
    bands: np.ndarray  # how many of them a piece has
    knot: np.ndarray  # least index of a piece of the same row that bands join it with


def joined(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label`` after joining the sets of a[i] and b[i] for every i; a set's label is its least index."""
    label = label.copy()
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != (label := label[label])).any():
            pass


def _lead(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the row before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Pieces]]:
    """(first row, last row + 1, pieces) of each slice that has any; doc_id and text are the first two columns."""
    for batch in batches:
        ids = np.array(batch.column(0))
        for a, b, data, offsets in slices(batch.column(1)):
            words = split(data, offsets)
            grams = runs(words.hashes(), SHINGLE)
            starts = paragraph_starts(words, grams)
            lines, sizes = line_units(words)
            at = np.concatenate([starts, lines])
            if not len(at):
                continue
            size = np.concatenate([np.full(len(starts), PARAGRAPH), sizes])
            count = size - SHINGLE + 1
            edges = np.concatenate([[0], np.cumsum(count)])
            within = np.arange(edges[-1]) - np.repeat(edges[:-1], count)
            where = np.repeat(at, count) + within
            own = grams[where]
            exact = mix(np.add.reduceat(mix(own + within.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), edges[:-1]))
            keys = np.zeros((len(at), LINE_BANDS), np.uint64)
            low = 0
            for band in range(LINE_BANDS):
                if band == BANDS:  # the others are for lines only
                    low = len(starts)
                    if low == len(at):
                        break
                key = np.full(len(at) - low, band + 1, np.uint64)
                for seed in _SEEDS[band * ROWS:(band + 1) * ROWS]:
                    least = np.minimum.reduceat(mix(grams ^ seed)[where[edges[low]:]], edges[low:-1] - edges[low])
                    key = mix(key * np.uint64(31) + least)
                keys[low:, band] = key
            doc = words.doc[at]
            bands = np.where(np.arange(len(at)) < len(starts), BANDS, LINE_BANDS)
            piece, key = _rows_of(keys, bands)
            order = np.lexsort((key, doc[piece]))
            piece, key = piece[order], key[order]
            same = np.flatnonzero(~_lead(key, doc[piece]))
            knot = joined(piece[same - 1], piece[same], np.arange(len(at)))
            yield a, b, Pieces(
                ids[a:b], doc, (at - words.first[doc]).astype(np.int32), size.astype(np.int32), own, edges,
                exact.view(np.int64), keys.view(np.int64), bands, knot,
            )


def _rows_of(keys: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, key) of each band that a piece has."""
    piece, band = np.nonzero(np.arange(LINE_BANDS)[None, :] < bands[:, None])
    return piece, keys[piece, band]


def _knots(p: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pieces by knot and class, where a knot begins, where a class does, least class of each knot, hash of its classes)."""
    order = np.lexsort((p.exact, p.knot))
    lead = _lead(p.knot[order])
    first = np.flatnonzero(lead)
    fresh = lead | _lead(p.exact[order])
    marks = np.where(fresh, mix(p.exact[order].view(np.uint64)), np.uint64(0))
    return order, first, fresh, p.exact[order][first], mix(np.add.reduceat(marks, first)).view(np.int64)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(values))


KNOTS = "doc_id long, root long, sig long, shingles long, exacts array<long>, starts array<int>, sizes array<int>, keys array<long>"


def _knot_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of KNOTS: the pieces of each knot and its distinct band keys.

    Two knots of a slice with one least class show that it repeats, so a third need not have the same key.
    """
    for _, _, p in _pieces(batches):
        order, first, fresh, root, sig = _knots(p)
        counts = np.diff(np.append(first, len(order)))
        nth = np.empty(len(order), np.int64)  # knot of each piece
        nth[order] = np.repeat(np.arange(len(first)), counts)
        piece, key = _rows_of(p.keys, p.bands)
        knot = nth[piece]
        by = np.lexsort((knot, key))
        knot, key = knot[by], key[by]
        once = _lead(key, knot)
        knot, key = knot[once], key[once]
        by = np.lexsort((root[knot], key))
        knot, key = knot[by], key[by]
        run = np.flatnonzero(_lead(key, root[knot]))
        rank = np.arange(len(key)) - np.repeat(run, np.diff(np.append(run, len(key))))
        knot, key = knot[rank < 2], key[rank < 2]
        by = np.argsort(knot, kind="stable")
        yield pa.RecordBatch.from_arrays([
            pa.array(p.ids[p.doc[order[first]]]), pa.array(root), pa.array(sig),
            pa.array(np.add.reduceat(np.where(fresh, np.diff(p.edges)[order], 0), first)), _lists(p.exact[order], counts), _lists(p.start[order], counts),
            _lists(p.size[order], counts), _lists(key[by], np.bincount(knot, minlength=len(first))),
        ], ["doc_id", "root", "sig", "shingles", "exacts", "starts", "sizes", "keys"])


def _named_classes(batch: pa.RecordBatch) -> Iterator[tuple[Pieces, np.ndarray, np.ndarray]]:
    """(pieces, one piece of each class in the knots that column 2 names for its document, which of the batch's named knots it is in)."""
    named = batch.column(2)
    low = np.asarray(named.offsets)
    sigs = np.asarray(named.values.field("sig"))
    for a, b, p in _pieces([batch]):
        order, first, fresh, _, sig = _knots(p)
        where = np.arange(low[a], low[b])
        row = np.repeat(np.arange(b - a), np.diff(low[a:b + 1]))
        # (row, sig) of the named ones are matched with those of the knots.
        doc = p.doc[order[first]]
        by = np.lexsort((np.concatenate([np.zeros(len(where), int), np.ones(len(doc), int)]), np.concatenate([sigs[where], sig]), np.concatenate([row, doc])))
        own = by >= len(where)
        lead = _lead(np.concatenate([sigs[where], sig])[by], np.concatenate([row, doc])[by])
        head = by[np.flatnonzero(lead)[np.cumsum(lead) - 1]]
        fit = own & (head < len(where))
        name = np.full(len(first), -1)
        name[by[fit] - len(where)] = where[head[fit]] if len(where) else 0
        each = np.repeat(name, np.diff(np.append(first, len(order))))
        take = fresh & (each >= 0)
        if take.any():
            yield p, order[take], each[take]


def _shingles_of(p: Pieces, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles of the pieces in the order of the text, how many each has)."""
    counts = np.diff(p.edges)[pieces]
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(p.edges[pieces], counts)
    return p.own[at].view(np.int64), counts


def _class_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, first_doc, last_doc, exacts, counts, items) of each named knot: its classes and their shingles."""
    for batch in batches:
        of = {n: np.asarray(batch.column(2).values.field(n)) for n in ("grp", "first_doc", "last_doc")}
        for p, pieces, name in _named_classes(batch):
            by = np.lexsort((p.start[pieces], name))  # neighbours share shingles, which then compress well
            pieces, name = pieces[by], name[by]
            first = np.flatnonzero(_lead(name))
            classes = np.diff(np.append(first, len(name)))
            items, counts = _shingles_of(p, pieces)
            yield pa.RecordBatch.from_arrays([
                *[pa.array(of[n][name[first]]) for n in of], _lists(p.exact[pieces], classes),
                _lists(counts.astype(np.int32), classes), _lists(items, np.add.reduceat(counts, first)),
            ], ["grp", *list(of)[1:], "exacts", "counts", "items"])


def _wide_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(exact, grp, first_doc, last_doc, items) of each class of each named knot, one at a time."""
    for batch in batches:
        of = {n: np.asarray(batch.column(2).values.field(n)) for n in ("grp", "first_doc", "last_doc")}
        for p, pieces, name in _named_classes(batch):
            items = [np.unique(p.own[p.edges[i]:p.edges[i + 1]]).view(np.int64) for i in pieces]
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.exact[pieces]), *[pa.array(of[n][name]) for n in of], _lists(np.concatenate(items), [len(x) for x in items])],
                ["exact", *of, "items"],
            )


def _near(a: np.ndarray, b: np.ndarray, items: np.ndarray, edges: np.ndarray, least: int, of: int) -> np.ndarray:
    """Whether the sets a[i] and b[i] are similar enough; set j is ``items[edges[j]:edges[j + 1]]``, ascending numbers below len(items)."""
    size = np.diff(edges)
    out = of * np.minimum(size[a], size[b]) >= least * np.maximum(size[a], size[b])
    todo = np.flatnonzero(out)
    ends = np.cumsum(size[a[todo]] + size[b[todo]])
    low = 0
    while low < len(todo):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CHUNK, "right")))
        pair = todo[low:high]
        sets = np.concatenate([a[pair], b[pair]])
        n = size[sets]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(edges[sets], n)
        # Two ascending halves, which a stable sort merges.
        key = np.sort(np.repeat(np.tile(np.arange(len(pair)) * len(items), 2), n) + items[at], kind="stable")
        common = np.bincount(key[1:][key[1:] == key[:-1]] // len(items), minlength=len(pair))
        out[pair] = of * common >= least * (size[a[pair]] + size[b[pair]] - common)
        low = high
    return out


def most_of_partner(size: np.ndarray, place: np.ndarray, least: int, of: int) -> np.ndarray:
    """The largest size of a set that can be similar to a set of ``size`` items if the first one they share is at ``place``, from 0.

    Similar sets of a and b items share at least (a + b) * least / (of + least).
    """
    return np.minimum((size - place) * (of + least) // least - size, size * of // least)


def linked_classes(grp: np.ndarray, items: np.ndarray, edges: np.ndarray, least: int, of: int) -> np.ndarray:
    """The least index that each set is linked with, over any number of links inside its group; a set's items ascend.

    The items of a set are put in one order, the rarest of the group first. What two sets share lies behind the first
    item they share, so an item's place bounds the size of the sets that may be similar and share no item before it.
    Only pairs within the bounds of both are compared.
    """
    size = np.diff(edges)
    owner = np.repeat(np.arange(len(size)), size)
    by = np.lexsort((items, grp[owner]))
    lead = _lead(items[by], grp[owner[by]])
    often = np.diff(np.append(np.flatnonzero(lead), len(by)))
    number = np.empty(len(by), np.int64)  # of an item in its group
    number[by] = np.cumsum(lead) - 1
    by = np.lexsort((number, often[number], owner))
    most = most_of_partner(size[owner], np.arange(len(by)) - edges[owner], least, of)
    some = (most * of >= least * size[owner]) & (often[number[by]] > 1)
    item, owner, most = number[by][some], owner[some], most[some]
    label = np.arange(len(size))
    top = int(size.max(initial=0)) + 1
    for steps in (16, len(item)):  # after some steps, sets of one size that are linked already lie together and are passed over
        by = np.lexsort((label[owner], size[owner], item))
        item, owner, most = item[by], owner[by], most[by]
        run = item * top
        stop = np.searchsorted(run + size[owner], run + np.minimum(most, top - 1), "right")
        last = np.flatnonzero(np.append(_lead(item, size[owner], label[owner])[1:], True))
        begin = last[np.searchsorted(last, np.arange(len(item)))]
        at, step = np.arange(len(item)), 1
        while step <= steps and len(at := at[begin[at] + step < stop[at]]):
            for low in range(0, len(at), CHUNK):
                x = at[low:low + CHUNK]
                y = begin[x] + step
                a, b = owner[x], owner[y]
                apart = (label[a] != label[b]) & (most[y] >= size[a])
                pair = np.unique(a[apart] * len(size) + b[apart])
                a, b = pair // len(size), pair % len(size)
                near = _near(a, b, number, edges, least, of)
                label = joined(a[near], b[near], label)
            step += 1
    return label


def _clusters(rows: pa.Table, least: int, of: int, every: bool) -> pa.RecordBatch:
    """(exact, cluster, first_doc) of the classes of whole groups of knots, of those whose cluster lies in several documents unless ``every``."""
    grp, first, last = (np.asarray(rows[n].combine_chunks()) for n in ("grp", "first_doc", "last_doc"))
    exacts, counts, items = (rows[n].combine_chunks() for n in ("exacts", "counts", "items"))
    knot = np.repeat(np.arange(len(grp)), np.diff(np.asarray(exacts.offsets)))
    exact, count, items = np.asarray(exacts.flatten()), np.asarray(counts.flatten()), np.asarray(items.flatten())
    by = np.lexsort((exact, grp[knot]))
    lead = np.flatnonzero(_lead(exact[by], grp[knot[by]]))
    kept, knots = by[lead], knot[by]
    first, last = np.minimum.reduceat(first[knots], lead), np.maximum.reduceat(last[knots], lead)
    begin = np.cumsum(count) - count
    n = count[kept]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[kept], n)
    owner, item = np.repeat(np.arange(len(kept)), n), items[at]
    order = np.lexsort((item, owner))
    owner, item = owner[order], item[order]
    fresh = _lead(owner, item)
    edges = np.concatenate([[0], np.cumsum(np.bincount(owner[fresh], minlength=len(kept)))])
    # Classes of a group lie by hash, so the first of a cluster has the least one.
    label = linked_classes(grp[knot[kept]], item[fresh], edges, least, of)
    low, high = first.copy(), last.copy()
    np.minimum.at(low, label, first)
    np.maximum.at(high, label, last)
    keep = (low[label] < high[label]) | every
    exact = exact[kept]
    return pa.RecordBatch.from_arrays(
        [pa.array(exact[keep]), pa.array(exact[label][keep]), pa.array(low[label][keep])], ["exact", "cluster", "first_doc"]
    )


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch sorted by group in portions of whole groups: up to GROUP shingles or a single group, the last one by itself."""
    lead = np.flatnonzero(_lead(np.asarray(batch.column(0))))
    edge = np.append(lead, batch.num_rows)
    sent = np.asarray(batch.column(5).offsets)[edge]
    low = 0
    while low < len(lead) - 1:
        high = max(low + 1, int(np.searchsorted(sent[:-1], sent[low] + GROUP, "right")) - 1)
        yield batch.slice(edge[low], edge[high] - edge[low])
        low = high
    yield batch.slice(edge[low])


def _cluster_batches(least: int, of: int, every: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches are sorted by group; the last group of a batch waits for the next one."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in _portions(batch) if batch.num_rows else ():
                if held and held[-1].column(0)[-1] != part.column(0)[0]:
                    yield _clusters(pa.Table.from_batches(held), least, of, every)
                    held = []
                held.append(part)
        if held:
            yield _clusters(pa.Table.from_batches(held), least, of, every)

    return run


def _wide_clusters(rows: DataFrame, least: int, of: int) -> DataFrame:
    """(exact, cluster, first_doc) like ``_clusters``, for groups too large for one task.

    Classes of a group meet where the first item that they share can be, as in ``linked_classes``. Where too many meet,
    they are linked with the one that has most room, and the rest is found as in ``near_dups``.
    """
    found = written(rows.mapInArrow(_wide_batches, "exact long, grp long, first_doc long, last_doc long, items array<long>"), "wide")
    sets = written(found.groupBy("exact").agg(
        F.min("grp").alias("grp"), F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc"), F.first("items").alias("items")
    ), "shingles")
    # The rarest items of a group come first, so that few sets meet; an item of one set alone only takes a place.
    size = F.size("items").cast("long")
    each = sets.select("exact", "grp", size.alias("size"), F.explode("items").alias("item"))
    often = written(each.groupBy("grp", "item").agg(F.count("*").alias("n")).filter("n > 1"), "often")
    ranked = each.join(often, ["grp", "item"]).groupBy("exact", "grp", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "item"))).alias("shared")
    ).withColumn("alone", F.col("size") - F.size("shared"))
    behind = F.col("size") - F.col("alone") - F.col("place")
    heads = written(ranked.select("exact", "grp", "size", "alone", F.posexplode(F.slice(
        "shared", F.lit(1), F.greatest(F.lit(0), F.col("size") - F.ceil(F.col("size") * least / of) + 1 - F.col("alone")).cast("int")
    )).alias("place", "s")).select("exact", "grp", "size", F.col("s.item").alias("item"), F.least(
        F.floor(behind * (of + least) / least) - F.col("size"), F.floor(F.col("size") * of / least)
    ).alias("most")), "heads")
    # The smaller set of a pair has room for one of its size; ``floor`` is the least such set.
    met = written(heads.groupBy("grp", "item").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles"), F.max(F.struct(F.col("most") - F.col("size"), "exact"))["exact"].alias("centre"),
        F.min(F.when(F.col("most") >= F.col("size"), F.col("size"))).alias("floor"),
    ).filter("n > 1 AND floor IS NOT NULL").drop("n"), "met")
    dealt = heads.join(met, ["grp", "item"]).filter("most >= floor").select(
        F.xxhash64("grp", "item").alias("grp"), "exact", "shingles", "centre"
    )
    near = written(dealt.filter(F.col("shingles") <= GROUP).select("grp", "exact").join(sets.drop("grp"), "exact").select(
        "grp", "first_doc", "last_doc", F.array("exact").alias("exacts"), F.array(F.size("items")).alias("counts"), "items"
    ).repartition("grp").sortWithinPartitions("grp").mapInArrow(
        _cluster_batches(least, of, every=True), "exact long, cluster long, first_doc long"
    ).filter("exact <> cluster").select(F.col("exact").alias("u"), F.col("cluster").alias("v")).distinct(), "near")
    proposed = written(dealt.filter((F.col("shingles") > GROUP) & (F.col("exact") != F.col("centre"))).select(
        F.col("exact").alias("u"), F.col("centre").alias("v")
    ).distinct(), "proposed")
    crowded = not proposed.isEmpty()
    if crowded:
        marked = sets.select(F.col("exact").alias("mark"), "items")
        near = near.unionByName(confirmed(proposed, marked, least, of))
    label = components(near)
    if crowded:
        ends = written(proposed.select(F.col("u").alias("mark")).unionByName(proposed.select(F.col("v").alias("mark"))).distinct(), "ends")
        more = rest_of_groups(proposed, ends, label.withColumnRenamed("id", "mark"), marked, least, of)
        if more is not None:
            label = components(label.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(written(more, "more")))
    named = written(sets.drop("grp", "items").join(label.withColumnRenamed("id", "exact"), "exact", "left").select(
        "exact", F.coalesce("component", "exact").alias("cluster"), "first_doc", "last_doc"
    ), "named")
    spread = named.groupBy("cluster").agg(F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc")).filter(
        "first_doc < last_doc"
    ).drop("last_doc")
    return named.select("exact", "cluster").join(spread, "cluster").select("exact", "cluster", "first_doc")


def repeated_passages(docs: DataFrame, text: str = "text", least: int = 80, of: int = 100) -> DataFrame:
    """(doc_id, start, end, cluster, first_doc, removed): word spans of passages that other documents have too.

    A span joins the overlapping or touching paragraphs of one document that repeat; ``removed`` is false where the
    document is the first of every cluster in the span. ``cluster`` numbers the first of them.

    Of knots with equal pieces only the first one's text is compared, so copies cost one small row each.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).filter(
        "doc_id IS NOT NULL"
    )
    # Whole texts reach Python in small batches, so that its workers and the Arrow buffers of the JVM stay small.
    with small_batches(docs.sparkSession, size=BATCH):
        knots = written(rows.mapInArrow(_knot_batches, KNOTS), "knots")
    # Knots that share a band are linked with the least of them, so that chains stay short; one that meets itself is in several rows.
    turn = Window.partitionBy("key").orderBy("root").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    links = written(knots.select(F.col("root"), F.explode("keys").alias("key")).select(
        F.col("root").alias("u"), F.first("root").over(turn).alias("v"), F.count("*").over(turn).alias("nth")
    ).filter("nth > 1").select("u", "v").distinct(), "meetings")
    touched = links.select(F.col("u").alias("root")).unionByName(links.select(F.col("v").alias("root"))).distinct()
    groups = touched.join(components(links, stored=True).withColumnRenamed("id", "root"), "root", "left").select(
        "root", F.coalesce("component", "root").alias("grp")
    )
    # Of knots with the same pieces one is enough.
    sigs = written(knots.groupBy("root", "sig").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.min("shingles").alias("shingles")
    ).join(groups, "root").drop("root"), "sigs")
    sizes = sigs.groupBy("grp").agg(
        F.sum("shingles").alias("size"), F.min("first_doc").alias("low"), F.max("last_doc").alias("high")
    ).filter("low < high").select("grp", (F.col("size") > GROUP).alias("wide"))
    named = written(sigs.join(sizes, "grp").groupBy(F.col("first_doc").alias("doc_id"), "wide").agg(
        F.collect_list(F.struct("sig", "grp", "first_doc", "last_doc")).alias("named"), F.count("*").alias("n")
    ), "named")

    def texts(wide: bool) -> DataFrame | None:
        wanted = named.filter(F.col("wide") == wide)
        n = wanted.agg(F.sum("n")).first()[0]
        return n and small_or_shuffled(rows, wanted.select("doc_id", "named"), "doc_id", n).select("doc_id", "text", "named")

    with small_batches(docs.sparkSession, size=BATCH):
        few, wide = texts(False), texts(True)
        parts = [] if few is None else [written(few.mapInArrow(
            _class_batches, "grp long, first_doc long, last_doc long, exacts array<long>, counts array<int>, items array<long>"
        ).repartition("grp").sortWithinPartitions("grp").mapInArrow(
            _cluster_batches(least, of), "exact long, cluster long, first_doc long"
        ), "clusters")]
        parts += [] if wide is None else [written(_wide_clusters(wide, least, of), "clusters")]
    repeated = parts[0] if parts else docs.sparkSession.createDataFrame([], "exact long, cluster long, first_doc long")
    for part in parts[1:]:
        repeated = repeated.unionByName(part)
    places = knots.select("doc_id", F.explode(F.arrays_zip("exacts", "starts", "sizes")).alias("p")).select(
        "doc_id", F.col("p.exacts").alias("exact"), F.col("p.starts").alias("start"), (F.col("p.starts") + F.col("p.sizes")).alias("end")
    )
    flagged = places.join(repeated, "exact").select("doc_id", "start", "end", "cluster", "first_doc")
    in_doc = Window.partitionBy("doc_id").orderBy("start", "cluster")
    before = in_doc.rowsBetween(Window.unboundedPreceding, -1)
    apart = (F.col("start") > F.max("end").over(before)).cast("int")
    return flagged.withColumn("apart", F.coalesce(apart, F.lit(1))).withColumn(
        "span", F.sum("apart").over(in_doc.rowsBetween(Window.unboundedPreceding, 0))
    ).groupBy("doc_id", "span").agg(
        F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"),
        F.min_by("cluster", "start").alias("cluster"), F.min("first_doc").alias("first_doc"),
        F.max(F.col("doc_id") != F.col("first_doc")).alias("removed"),
    ).drop("span")
