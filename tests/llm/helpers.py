"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import re
from itertools import combinations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 40_000

# Names that results and intermediate columns also have.
CLASHING = {c: "extra" for c in (
    "spans", "score", "lang_pred", "id", "rank", "taken", "size", "hash", "row", "word", "mark", "key", "v", "kind", "pattern", "blob_id", "todo",
)}

ODD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, "b", 3), (4, "12 34 %%", "de", None, 8),
    (5, "one two", "en", "b", 7), (6, "one two", "en", "b", 7), (7, LONG, "en", "a", len(LONG)),
    (None, "one two three four", None, "c", 18), (8, "Ünïcode ßtraße 漢字 words here", "de", "c", 28),
    (8, "Ünïcode ßtraße 漢字 words here", "de", "c", 28), (9, "x" * 3000, "en", None, 3000),
]


def odd_docs(spark, rows=ODD):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(v) for c, v in CLASHING.items()})


def words(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0d]+", low)


def shingle_set(text: str | None, k: int) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def least_reachable(ids, links) -> dict:
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_components(texts: dict, k: int, least: int, of: int = 100) -> dict:
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    links = [
        (a, b) for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and of * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])
    ]
    return least_reachable(texts, links)
