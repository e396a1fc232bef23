from __future__ import annotations

import random

import numpy as np
import pytest

from stakeflow.llm import near_dups
from stakeflow.llm.components import components
from tests.llm.helpers import near_components, least_reachable, odd_docs


def labels(spark, texts: dict, **options) -> dict:
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r["doc_id"]: r["component_id"] for r in near_dups.digest(near_dups.near_duplicates(docs, **options)).collect()}


def edited(base: list[str], n: int, rng) -> str:
    out = list(base)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"edit{rng.random()}"
    return " ".join(out)


@pytest.mark.parametrize("block", [256, 3])
def test_components_equal_brute_force(spark, monkeypatch, block):
    """Copies with so many edits that few of them are near each other: stars alone miss links."""
    monkeypatch.setattr(near_dups, "BLOCK", block)
    rng = random.Random(block)
    texts = {}
    for group in range(3):
        base = [f"w{group}-{i}" for i in range(120)]
        chain = list(base)
        for j in range(25):
            texts[group * 100 + j] = edited(base, rng.randint(0, 4), rng)
            chain[rng.randrange(120)] = f"drift{group}{j}"
            texts[group * 100 + 50 + j] = " ".join(chain)
    texts |= {900: "one two", 901: "one two", 902: "one", 903: "", 904: "a b c d e f g h", 905: "a b c d e f g h i"}
    assert labels(spark, texts, k=3, least=85) == near_components(texts, 3, 85)


def test_odd_rows(spark):
    found = near_dups.digest(near_dups.near_duplicates(odd_docs(spark), k=3, least=85)).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 11
    assert by_id[1]["n_shingles"] == by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == 0 and by_id[1]["kept"]
    assert by_id[6]["component_id"] == 5 and not by_id[6]["kept"] and by_id[7]["n_shingles"] == 3
    assert by_id[None]["component_id"] is None and not by_id[None]["kept"]
    kept = near_dups.keep_one(odd_docs(spark), near_dups.near_duplicates(odd_docs(spark), k=3, least=85))
    assert sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 8, 9]
    assert near_dups.near_duplicates(odd_docs(spark, [])).count() == 0


def test_rows_of_one_document_share_a_component(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "p q r s"), (3, "a b c d"), (3, "p q r s")], "doc_id long, text string")
    assert {r["component_id"] for r in near_dups.near_duplicates(docs, k=3, least=85).collect()} == {1}


def test_connected_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1200)] + [(7, 7)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    ids = {x for a, b in links if a != b for x in (a, b)}
    assert found == least_reachable(ids, [l for l in links if l[0] != l[1]])


def test_densified_bins_do_not_depend_on_the_set():
    least = np.zeros((2, near_dups.BINS), np.uint64)
    empty = np.ones((2, near_dups.BINS), bool)
    least[:, [3, 90]], empty[:, [3, 90]] = [7, 9], False
    out = near_dups.densified(least, empty)
    assert set(out[0]) == {7, 9} and (out[0] == out[1]).all()


def test_overlaps():
    sets = [np.array(sorted({random.Random(i).randrange(60) for _ in range(20)})) for i in range(9)]
    found = near_dups.overlaps(sets[:4], sets[4:], width=7)
    assert found.tolist() == [[len(set(a) & set(b)) for b in sets[4:]] for a in sets[:4]]
