from __future__ import annotations

import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stakeflow.llm import filter_audit
from tests.llm.helpers import LONG, ODD, odd_docs

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def plain_counts(text: str | None) -> tuple:
    t = text or ""
    w = WORD.findall(t)
    return len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall("[#$%&*|]", t))


def as_arrays(texts):
    raw = [(t or "").encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), offsets


TEXTS = ["", " ", "a", "A b a", "Word word WORD word", "x\ty\nx", "ünï ünï ÜNÏ 漢字", "#$ % & * | ok", LONG, " lead trail "]


def test_transducer_equals_plain_counting():
    data, offsets = as_arrays(TEXTS)
    found = filter_audit.transduce(data, offsets)
    assert [tuple(r) for r in found] == [plain_counts(t) for t in TEXTS]


def test_colliding_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(filter_audit, "_word_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    data, offsets = as_arrays(TEXTS)
    assert [tuple(r) for r in filter_audit.transduce(data, offsets)] == [plain_counts(t) for t in TEXTS]


def brute_audit(docs, labels):
    """Every order and step, document by document."""
    good = {d for d, q, t in labels if q == 1 and d is not None}
    toxic = {d for d, q, t in labels if t == 1 and d is not None}
    rows = []
    for doc_id, text, part in docs:
        n, distinct, caps, points, symbols = plain_counts(text)
        same_smaller = any(o is not None and doc_id is not None and o < doc_id and (t or "") == (text or "") for o, t, _ in docs)
        fails = {"A": n < 200, "B": 100 * distinct < 50 * n, "C": 100 * caps > 2 * points, "D": symbols > 0, "E": same_smaller}
        rows.append((doc_id, part or "", fails))
    out = {}
    for part in {p for _, p, _ in rows}:
        mine = [r for r in rows if r[1] == part]
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = order[:step - 1]
                here = [r for r in mine if r[2][letter] and not any(r[2][b] for b in before)]
                out[(part, "".join(order), step)] = dict(
                    kept=sum(not any(r[2][b] for b in order[:step]) for r in mine), removed=len(here),
                    redundant=sum(r[2][letter] and any(r[2][b] for b in before) for r in mine),
                    unique_fails=sum(r[2][letter] and sum(r[2].values()) == 1 for r in mine),
                    good_lost=sum(r[0] in good for r in here), toxic_lost=sum(r[0] in toxic for r in here),
                )
        for letter in "ABCDE":
            total = sum(v["removed"] for (p, o, s), v in out.items() if p == part and o[s - 1] == letter)
            for (p, o, s), v in out.items():
                if p == part and o[s - 1] == letter:
                    v["shapley"] = total
    return out


@pytest.mark.parametrize("hot", [1000, 1])
def test_audit_equals_brute_force_on_odd_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(filter_audit, "HOT_COPIES", hot)  # 1: every repeated text takes the broadcast path
    wordy = " ".join(f"w{i}" for i in range(250))
    rows = list(ODD) + [
        (20, wordy, "en", "a", 1), (21, wordy, "en", "a", 1), (19, wordy + " #", "en", "b", 1), (22, wordy.upper(), "en", "a", 1),
        (23, "rep " * 300, "en", None, 1), (24, None, "en", "a", 0),
    ]
    labels = [(20, 1, 0), (21, 1, 1), (21, None, None), (5, 0, 1), (None, 1, 1), (99, 1, 1)]
    docs = odd_docs(spark, rows)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("score", F.lit(1))
    found = {(r["part"], r["filter_order"], r["step"]): {k: r[k] for k in r.asDict() if k not in ("part", "filter_order", "step")}
             for r in filter_audit.audit(docs, lab).collect()}
    expected = brute_audit([(r[0], r[1], r[3]) for r in rows], labels)
    assert found == expected
    assert len(found) == 120 * 5 * len({r[3] or "" for r in rows})


def test_empty_table_gives_no_rows(spark):
    docs = odd_docs(spark, []).limit(0)
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, lab).count() == 0


@pytest.mark.parametrize("text", [" " * 200_000, "A" * 300_000, "ab " * 100_000])
def test_very_long_texts_are_counted_whole(text):
    data, offsets = as_arrays([text, "x"])
    assert [tuple(r) for r in filter_audit.transduce(data, offsets)] == [plain_counts(text), plain_counts("x")]
