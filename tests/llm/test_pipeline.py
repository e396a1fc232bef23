from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stakeflow.llm import decontaminate, language_id, mixture, near_dups, queries, secret_ledger
from tests.llm.helpers import SMALL, near_components, odd_docs, shingle_set, words
from verification.compare import connect, rows_of


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    found = connect(SMALL).execute(queries.ORACLES[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([c[0] for c in found.description], found.fetchall())


def brute_survivors(docs: dict, items: list[str]) -> set:
    kept = {i: t for i, t in docs.items() if re.search(r"[^\W\d_]", t or "")}
    label = near_components(kept, 5, 80)
    kept = {i: t for i, t in kept.items() if label[i] == i}

    def share(part: str, text: str) -> float:
        w = words(part)
        return 1.0 if not w else len(shingle_set(part, 5) & shingle_set(text, min(5, len(w)))) / len(shingle_set(part, 5))

    def leaks(text: str) -> bool:
        return any(min(share(q, text), share(a, text)) >= 0.8 for q, a in map(decontaminate.question_and_answer, items))

    kept = {i: t for i, t in kept.items() if not leaks(t)}
    secret = lambda t: any(len(m[r.value]) >= r.least for r in secret_ledger.RULES for m in re.finditer(r.pattern, t))
    return {i for i, t in kept.items() if not secret(t)}


def test_pipeline_equals_brute_force(spark):
    con = duckdb.connect()
    docs = dict(con.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    items = [r[0] for r in con.sql(f"SELECT text FROM '{SMALL}/benchmark.parquet'").fetchall()]
    found = corpus_pipeline.run(spark, SMALL)
    assert {r["doc_id"] for r in found.collect()} == brute_survivors(docs, items)
    again = mixture.mix(spark.read.parquet(f"{SMALL}/documents.parquet").join(found.select("doc_id"), "doc_id", "left_semi"))
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in found.collect()}


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        assert out.count() <= docs.count()
    assert stage_ids(corpus_pipeline.language(spark, docs, SMALL)) == [0, 5, 6, 7, 8, 8, 9]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs(spark, []), SMALL).count() == 0


def stage_ids(df) -> list:
    return sorted(r["doc_id"] or 0 for r in df.select("doc_id").collect())


def test_whole_texts_reach_python_in_small_batches(spark, monkeypatch):
    """In the counts of the first stage and in near duplicates, also where a stage runs on its own."""
    def bounded(made):
        def of(*args):
            inner = made(*args)

            def run(batches):
                def checked():
                    for batch in batches:
                        if batch.num_rows > 2000:
                            raise ValueError(f"a batch of {batch.num_rows} rows")
                        yield batch

                return inner(checked())

            return run

        return of

    for module, name in ((language_id, "_count_batches"), (near_dups, "_sketch_batches"), (near_dups, "_set_batches")):
        monkeypatch.setattr(module, name, bounded(getattr(module, name)))
    docs = odd_docs(spark, [(i, f"some plain words of document number {i}", "en", "a", 9) for i in range(5000)]).coalesce(1)
    assert corpus_pipeline.language(spark, docs, SMALL).count() == 5000
    assert corpus_pipeline.near_duplicates(spark, docs, SMALL).count() == 5000
