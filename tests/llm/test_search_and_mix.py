from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stakeflow.llm import components, decontaminate, exact_topk, mixture, passage_dups, token_rollup
from stakeflow.llm.scratch import small_batches
from tests.llm.helpers import ODD, SMALL, least_reachable, near_components, odd_docs, words


def brute_topk(rows, k, every):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            good.setdefault(i, set()).add(tuple(np.floor(64 * np.array(v, float)).astype(int)))
    out = set()
    for q in (i for i in good if i % every == 0):
        for qv in good[q]:
            scored = sorted({(-int(np.dot(qv, c)), i) for i, cs in good.items() if i != q for c in cs if len(c) == len(qv)})
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("block", [10_000, 3])
def test_topk_equals_brute_force(spark, block):
    rng = np.random.default_rng(block)
    rows = [(i, [float(x) for x in rng.normal(0, rng.choice([0.1, 1, 5]), 8)]) for i in range(700)]
    rows += [(1000 + i, [1.0] * 8) for i in range(30)] + [(2000, [0.0] * 8), (2001, None), (2002, [])]
    rows += [(2020, [1.0, None] + [0.0] * 6), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8), (None, [1.0] * 8), (2080, [3.0, 4.0])]
    rows += [(2100, [2.0, 1.0]), rows[20], rows[21]]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(5)
    whole = docs.select(F.col("vec_id"), exact_topk.whole_vectors(docs, F.col("embedding")).alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    found = exact_topk.top_k(whole.filter("vec_id % 20 = 0"), whole, 5, block=block)
    assert {tuple(r) for r in found.collect()} == brute_topk(rows, 5, 20)
    assert exact_topk.search(docs.limit(0)).count() == 0


def test_copies_in_many_batches_take_one_place(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 8)]) for i in range(1, 90)] + [(100, [2.0] * 8)]
    copies = [r for i in range(40) for r in ((101, [9.0] * 8), rows[i], (102, [8.0] * 8))]  # in batches of 5: in 24 of them
    docs = spark.createDataFrame(rows[:45] + copies + rows[45:], "vec_id long, embedding array<double>").coalesce(1)
    with small_batches(spark, 5):
        found = {tuple(r) for r in exact_topk.search(docs, k=6, every=20).collect()}
    assert found == brute_topk(rows + copies, 6, 20) and len(found) == 6 * 5


def test_steep_buckets_are_pruned_and_still_right():
    rng = np.random.default_rng(2)
    c = rng.integers(-3, 4, (3000, 16))
    c[:40] *= 50
    q = c[:10] + rng.integers(-1, 2, (10, 16))
    best = exact_topk.Best(10, 7)
    for a in range(0, 3000, 500):
        exact_topk.improve(best, np.arange(10) - 100, q, np.arange(a, a + 500), c[a:a + 500])
    full = q @ c.T
    for i in range(10):
        order = np.lexsort((np.arange(3000), -full[i]))[:7]
        assert best.id[i].tolist() == order.tolist() and best.score[i].tolist() == full[i][order].tolist()


def test_wand_retrieves_what_full_scoring_does(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"t{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(3, 30))) for _ in range(60)]
    index = decontaminate.build_index(list(range(60)), texts)
    everything = {}
    for (term, _), (items, weights) in index["postings"].items():
        for i, w in zip(items, weights):
            everything.setdefault(i, {})[term] = w
    for _ in range(300):
        held = rng.sample(range(len(index["terms"])), rng.randint(1, 40))
        found = {i: s for b in range(index["ceiling"].shape[1]) for i, s in decontaminate.wand(index, held, b, 0.3)}
        full = {i: sum(w.get(t, 0) for t in held) for i, w in everything.items()}
        assert found.keys() == {i for i, s in full.items() if s >= 0.3}
        assert all(found[i] == pytest.approx(full[i]) for i in found)


def test_items_are_found_wherever_they_lie(spark):
    rng = random.Random(9)
    prose = lambda n: [f"word{rng.randrange(4000)}" for _ in range(n)]
    items = [" ".join(prose(30)).capitalize() + ". " + " ".join(prose(9)) + "." for _ in range(25)]
    docs = []
    for i in range(120):
        w = prose(rng.choice([5, 60, 700]))
        if i % 3 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = items[i % 25].upper().split()
        if i % 7 == 0:
            w += items[(i + 1) % 25].split()[:25]  # the question without the answer
        docs.append((i, " ".join(w)))
    bench = spark.createDataFrame([*enumerate(items), (50, None), (51, ""), (52, "Few words.")], "item_id long, text string")
    for shard in (2048, 10):
        found = decontaminate.find_items(spark.createDataFrame(docs, "doc_id long, text string"), bench, shard=shard)
        assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(i, i % 25) for i in range(0, 120, 3)}
    clean = decontaminate.without_items(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == [i for i in range(120) if i % 3]


def test_items_with_a_glued_or_edited_word_are_found(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join(f"term{rng.randrange(4000)}" for _ in range(n))
    question, answer = prose(40).capitalize() + ".", prose(4) + " for."
    edited = " ".join([*answer.split()[:3], "other", "for."])
    short = prose(7)
    docs = [
        f"{question} {answer}&&& {prose(30)}", f"{prose(20)} ({question} {answer})", f"{prose(20)} \u201c{question} {answer}\u201d",
        f"{prose(300)} {question} {answer[:-1]}{prose(50)}", f"{question} {edited} {prose(30)}", f"-- {short}&&& {prose(9)}",
        f"{question} So we ask and say: {answer} {prose(30)}", f"{prose(30)} {answer}", " ".join(question.split()[:25]),
    ]
    bench = spark.createDataFrame([(0, f"{question} {answer}"), (1, short), (2, "?! ++")], "item_id long, text string")
    found = decontaminate.find_items(spark.createDataFrame([*enumerate(docs)], "doc_id long, text string"), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, 1), (6, 0)}
    overlaps = {r["doc_id"]: (r["item_overlap"], r["question_overlap"], r["answer_overlap"]) for r in found}
    assert overlaps[0] == (1, 1, 1) and overlaps[4][0] > 0.8 and overlaps[4][2] == 0


def test_shards_score_as_one_index(spark):
    rng = random.Random(6)
    texts = [" ".join(f"t{int(rng.paretovariate(0.6)) % 500}" for _ in range(rng.randint(1, 40))) for _ in range(70)]
    bench = spark.createDataFrame([*enumerate([*texts, texts[0]]), (99, None), (None, " ")], "item_id long, text string")

    def weights(shard):
        found = {}
        for index in decontaminate.indexes(bench, shard):
            for (term, _), (items, values) in index["postings"].items():
                found |= {(index["ids"][i], int(index["terms"][term])): v for i, v in zip(items, values)}
        return found

    one = weights(2048)
    assert weights(9) == pytest.approx(one) and len({i for i, _ in one}) == 71


def test_decontamination_odd_rows(spark):
    bench = spark.createDataFrame([(1, "one two three four", "x"), (None, "漢字 words here", "x")], "item_id long, text string, score string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(odd_docs(spark), bench).collect()}
    assert found == {(None, 1), (8, None)}
    assert decontaminate.find_items(odd_docs(spark), bench.limit(0)).count() == 0
    assert decontaminate.find_items(odd_docs(spark, []), bench).count() == 0
    kept = decontaminate.without_items(odd_docs(spark), bench)
    assert kept.count() == len(ODD) - 3 and kept.columns == odd_docs(spark).columns


def test_flow_repeats_as_little_as_it_can():
    # Words of b serve both; a alone would have to repeat its own.
    flow = mixture.min_cost_flow({("a",): 10, ("a", "b"): 30, ("b",): 10}, {"a": 30.0, "b": 20.0})
    assert sum(flow["a",].values()) == 10 and sum(flow["a", "b"].values()) == 30 and sum(flow["b",].values()) == 10
    assert flow["a",]["a"] + flow["a", "b"]["a"] == pytest.approx(30)
    flow = mixture.min_cost_flow({("a",): 10, ("b",): 40}, {"a": 30.0, "b": 20.0})
    assert flow["a",]["a"] == 30 and flow["b",]["b"] == 20
    flow = mixture.min_cost_flow({("a", "b"): 10, ("b", "c"): 10, ("c",): 10}, {"a": 10.0, "b": 10.0, "c": 10.0}, 1)
    assert sum(sum(f.values()) for f in flow.values()) == pytest.approx(30)


def test_targets_stop_and_are_reshared():
    target = mixture.weighted_targets({"a": 1000, "b": 10, "c": 500, None: 100})
    assert target["b"] == 30 and target["a"] + target["b"] + target["c"] + target[None] == pytest.approx(1610)
    assert target[None] == 300 or target["c"] == 3 * target["a"]


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(600)
    first, second = ({(r["doc_id"], r["taken"]) for r in mixture.mix(docs).collect()} for _ in range(2))
    assert first == second
    found = mixture.mix(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") / F.col("size")).alias("most"), F.min("size").alias("least"),
    ).collect()
    for r in found:
        assert abs(r["taken"] - r["target"]) < 0.1 * r["target"] + 50 and r["most"] <= 3


def test_mix_over_shared_documents(spark):
    docs = spark.createDataFrame([(i, "w " * 10, None, "a" if i % 2 else "b", 0) for i in range(100)], "doc_id long, text string, lang string, source string, n_chars long")
    found = mixture.mix(docs, members=F.array(F.lit("a"), F.lit("b"))).agg(F.sum("taken"), F.max("taken")).first()
    assert found[0] == 1000 and found[1] == 10


def test_mix_odd_rows(spark):
    found = mixture.mix(odd_docs(spark)).collect()
    assert len(found) == len(ODD) and all(r["taken"] == 0 for r in found if r["size"] == 0)
    assert {r["source"] for r in found} == {"a", "b", "c", None}
    assert mixture.mix(odd_docs(spark, [])).count() == 0


def test_rollup_follows_signed_deltas(spark, tmp_path):
    path = str(tmp_path / "rollup")
    tokenizer = token_rollup.read_tokenizer("byte_bpe_50k")
    enc = token_rollup.encoding("x", tokenizer.ranks)
    make = lambda rows: token_rollup.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, tokens long"), [tokenizer])
    n = lambda *texts: sum(len(enc.encode_ordinary(t or "")) for t in texts)
    one = make([(1, "Hello there", "a", "en", 0), (2, "straße", "a", "de", 0), (3, None, None, None, 0), (3, None, None, None, 0)])
    token_rollup.commit(token_rollup.insertions(one), path, "1")

    def now():
        return {(r["source"], r["lang"]): (r["documents"], r["tokens"]) for r in token_rollup.totals(spark, path).collect()}

    assert now() == {("a", "en"): (1, n("Hello there")), ("a", "de"): (1, n("straße")), (None, None): (2, 0)}
    changed = make([(1, "Hello there again", "a", "en", 0), (2, "straße", "b", "de", 0)])
    before = one.filter("doc_id < 3")
    for _ in range(3):
        token_rollup.commit(token_rollup.revisions(before, changed), path, "2")
    token_rollup.commit(token_rollup.deletions(one.filter("doc_id = 3")), path, "3")
    assert now() == {("a", "en"): (1, n("Hello there again")), ("b", "de"): (1, n("straße"))}
    token_rollup.commit(token_rollup.insertions(make([]) if False else one.limit(0)), path, "4")
    assert len(now()) == 2
    assert tokenizer.version != tokenizer._replace(ranks=tokenizer.ranks + b"\n").version


def test_rollup_odd_rows(spark):
    tokenizer = token_rollup.read_tokenizer("byte_bpe_50k")
    counted = token_rollup.count_tokens(odd_docs(spark), [tokenizer])
    assert counted.count() == len(ODD) and counted.filter("doc_id = 7").first()["tokens"] > 40_000


def test_passages_of_51_words_are_found(spark):
    rng = random.Random(11)
    prose = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    shared = [prose(51) for _ in range(12)]
    docs = {}
    for i, passage in enumerate(shared):
        for copy in range(2 + (i == 0) * 30):
            docs[100 * i + copy] = f"{prose(rng.randint(0, 80))} {passage if copy % 2 else passage.upper()} {prose(rng.randint(0, 80))}"
    clean = {5000 + i: prose(150) for i in range(40)}
    twice = prose(60)
    clean[6000] = f"{twice} {prose(5)} {twice}"
    found = passage_dups.repeated_passages(spark.createDataFrame(list((docs | clean).items()), "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found} == set(docs)
    assert all(r["removed"] == (r["doc_id"] % 100 != 0) and r["first_doc"] == r["doc_id"] // 100 * 100 for r in found)


def test_edited_passages_are_verified_by_similarity(spark):
    rng = random.Random(3)
    base = [f"u{i}" for i in range(26)]
    near, far = list(base), list(base)
    near[0] = "other"  # one of 22 shingles differs: 21 / 23
    for i in (5, 12, 20):
        far[i] = f"x{i}"
    texts = {1: " ".join(base), 2: " ".join(near), 3: " ".join(far)}
    found = {r["doc_id"] for r in passage_dups.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert found == {1, 2}


def test_lines_with_an_edit_in_the_middle_equal_brute_force(spark):
    rng = random.Random(12)
    prose = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    lines = {}
    for i in range(80):
        base = prose(55 + i % 6)
        edited = list(base)
        edited[len(base) // 2] = "edited"
        for side, line in enumerate((base, edited)):
            cut = [" ".join(line[a:a + 14]) for a in range(0, len(line), 14)]
            passage = "\n".join(cut) if i % 4 == 3 else " ".join(line)
            around = [" ".join(prose(rng.choice([5, 40]))) for _ in range(2)]
            lines[2 * i + side] = f"{around[0]}\n{passage}\n{around[1]}", " ".join(line)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in lines.items()], "doc_id long, text string")
    found = passage_dups.repeated_passages(docs).collect()
    expected = near_components({i: x for i, (_, x) in lines.items()}, 5, 80)
    assert len(set(expected.values())) == 80
    assert {(r["doc_id"], r["first_doc"]) for r in found} == set(expected.items())
    # A span has the whole line; a paragraph over its edge may add a word or two.
    for r in found:
        text, line = lines[r["doc_id"]]
        at = text.split().index(line.split()[0])
        assert at - 2 <= r["start"] <= at and 0 <= r["end"] - at - len(line.split()) <= 2 or r["doc_id"] // 2 % 4 == 3


def test_passages_odd_rows(spark):
    long = " ".join(f"q{i}" for i in range(60))
    rows = [*ODD, (20, long, "en", "a", 1), (21, long, "en", "a", 1), (None, long, "en", "a", 1), (22, None, "en", "a", 1)]
    found = {r["doc_id"]: (r["start"], r["removed"]) for r in passage_dups.repeated_passages(odd_docs(spark, rows)).collect()}
    assert set(found) == {20, 21} and found[21][1] and not found[20][1]
    assert passage_dups.repeated_passages(odd_docs(spark, [])).count() == 0


def test_passages_of_one_document_send_no_shingles(spark, monkeypatch):
    """Overlapping paragraphs of one document share bands; only what several documents have is compared."""
    rng = random.Random(21)
    prose = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = {i: " ".join(prose(400)) for i in range(30)}
    shared = prose(70)
    texts |= {100 + i: " ".join(prose(200) + shared + prose(200)) for i in range(2)}
    tables, written = {}, passage_dups.written

    def counted(df, purpose):
        tables[purpose] = written(df, purpose)
        return tables[purpose]

    monkeypatch.setattr(passage_dups, "written", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in passage_dups.repeated_passages(docs).collect()} == {100, 101}
    assert sum(t.count() for purpose, t in tables.items() if purpose != "knots") < 100


@pytest.mark.parametrize("group", [0, 60, 1500])
def test_passages_do_not_depend_on_the_size_of_groups(spark, monkeypatch, group):
    rng = random.Random(22)
    prose = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = {}
    for i in range(4):
        passage = prose(60)
        for j in range(12):
            own = list(passage)
            for at in rng.sample(range(60), rng.randint(0, 3)):
                own[at] = f"edit{rng.random()}"
            texts[100 * i + j] = f"{' '.join(prose(40))}\n{' '.join(own)}\n{' '.join(prose(40))}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = sorted(passage_dups.repeated_passages(docs).collect())
    assert len({r["cluster"] for r in found}) >= 4
    monkeypatch.setattr(passage_dups, "GROUP", group)
    assert sorted(passage_dups.repeated_passages(docs).collect()) == found


def test_groups_of_one_batch_are_compared_in_portions(monkeypatch):
    """A batch holds many groups; no more than GROUP shingles of them are compared at a time, in whole groups."""
    rng = np.random.default_rng(24)
    sizes = rng.integers(1, 9, 40)  # classes of each group
    grp = np.repeat(np.arange(40), sizes)
    base = rng.integers(0, 2**40, (40, 30))
    items = base[grp].copy()
    items[:, 0] = rng.integers(0, 2**40, len(grp))
    n = len(grp)
    rows = pa.RecordBatch.from_arrays([
        pa.array(grp), pa.array(np.arange(n)), pa.array(np.arange(n)), passage_dups._lists(np.arange(n) * 7, np.ones(n, int)),
        passage_dups._lists(np.full(n, 30, np.int32), np.ones(n, int)), passage_dups._lists(items.ravel(), np.full(n, 30)),
    ], ["grp", "first_doc", "last_doc", "exacts", "counts", "items"])
    seen, clusters = [], passage_dups._clusters

    def counted(table, *args):
        seen.append((len(set(table["grp"].to_pylist())), sum(map(len, table["items"].to_pylist()))))
        return clusters(table, *args)

    def found(width):
        parts = [rows.slice(low, width) for low in range(0, n, width)]
        out = passage_dups._cluster_batches(80, 100)(iter([*parts, rows.slice(0, 0)]))
        return sorted(tuple(r.values()) for b in out for r in b.to_pylist())

    whole = found(n)
    assert {r[0] for r in whole} == {7 * i for i in range(n) if sizes[grp[i]] > 1} and len({r[1] for r in whole}) == (sizes > 1).sum()
    monkeypatch.setattr(passage_dups, "_clusters", counted)
    monkeypatch.setattr(passage_dups, "GROUP", 500)
    assert found(n) == whole
    assert sum(groups for groups, _ in seen) == 40 and any(groups > 1 for groups, _ in seen)
    assert all(shingles <= 500 for _, shingles in seen)
    assert found(7) == found(1) == whole


def test_small_batches_limits_bytes_and_restores_both_settings(spark):
    names = [f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes")]
    before = [spark.conf.get(n) for n in names]
    with small_batches(spark, 5, size=1000):
        assert [spark.conf.get(n) for n in names] == ["5", "1000"]
    with small_batches(spark, 5):
        assert [spark.conf.get(n) for n in names] == ["5", before[1]]
    assert [spark.conf.get(n) for n in names] == before


def test_a_passage_of_many_documents_takes_few_rounds(spark, monkeypatch):
    """Knots that share a band are linked with one of them, not in a chain."""
    rng = random.Random(25)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared = prose(60)
    docs = spark.createDataFrame([(i, f"{prose(40)} {shared} {prose(40)}") for i in range(200)], "doc_id long, text string")
    rounds, written = [], components.written
    monkeypatch.setattr(components, "written", lambda df, purpose: rounds.append(purpose) or written(df, purpose))
    found = passage_dups.repeated_passages(docs).collect()
    assert {(r["doc_id"], r["first_doc"]) for r in found} == {(i, 0) for i in range(200)}
    assert len(rounds) <= 2


def test_linked_classes_equal_brute_force():
    rng = np.random.default_rng(23)
    sets, grp = [], []
    for g in range(12):
        base = rng.integers(0, 2**40, 60)
        for _ in range(14):
            low = rng.integers(0, 30)
            own = base[low:low + rng.integers(4, 26)].copy()
            own[rng.random(len(own)) < 0.05] = rng.integers(0, 2**40)
            sets.append(np.unique(own))
            grp.append(g // 2)
    edges = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    found = passage_dups.linked_classes(np.array(grp), np.concatenate(sets), edges, 80, 100)
    links = [
        (a, b) for a in range(len(sets)) for b in range(a)
        if grp[a] == grp[b] and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
    ]
    assert found.tolist() == [least_reachable(range(len(sets)), links)[i] for i in range(len(sets))]


def test_edited_copies_in_one_group_are_compared_with_few(monkeypatch):
    """Copies with edits of their own share most shingles but are not similar; few pairs of them are compared."""
    rng = np.random.default_rng(26)
    base = rng.integers(0, 2**40, 22)
    sets = []
    for i in range(300):  # more edits than a similar set can have, but for the last ones
        own, n = base.copy(), rng.integers(3, 5) if i < 290 else 1
        own[rng.permutation(22)[:n]] = rng.integers(2**41, 2**42, n)
        sets.append(np.unique(own))
    edges = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    pairs, near = [], passage_dups._near
    monkeypatch.setattr(passage_dups, "_near", lambda a, *args: pairs.append(len(a)) or near(a, *args))
    found = passage_dups.linked_classes(np.zeros(300, int), np.concatenate(sets), edges, 80, 100)
    links = [
        (a, b) for a in range(300) for b in range(a)
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
    ]
    assert found.tolist() == [least_reachable(range(300), links)[i] for i in range(300)]
    assert len(set(found)) < 300 and sum(pairs) < 300 * 10


def test_large_groups_of_edited_copies_meet_by_rare_shingles(spark, monkeypatch):
    """A shingle of all copies is no reason to compare them, however their hashes lie."""
    rng = random.Random(27)
    passage = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    texts = {}
    for i in range(80):
        own = list(passage)
        for at in (rng.randint(4, 24), rng.randint(30, 55)):  # 10 of 56 shingles
            own[at] = f"edit{rng.random()}"
        texts[i] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = sorted(passage_dups.repeated_passages(docs).collect())
    tables, written = {}, passage_dups.written

    def kept(df, purpose):
        tables[purpose] = written(df, purpose)
        return tables[purpose]

    monkeypatch.setattr(passage_dups, "written", kept)
    monkeypatch.setattr(passage_dups, "GROUP", 2500)
    assert sorted(passage_dups.repeated_passages(docs).collect()) == found
    assert tables["wide"].count() > 0 and tables["proposed"].count() == 0
