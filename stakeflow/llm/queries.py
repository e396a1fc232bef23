"""One query per operator, over its whole table, and the SQL it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stakeflow.llm import (
    centroids, decontaminate, exact_topk, filter_audit, language_id, lm_scoring, mixture, near_dups, passage_dups, quality_pu, secret_ledger,
    token_rollup, toxicity,
)
from stakeflow.llm.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- 1: exact top-k ---------------------------------------------------------------

query("op1_exact_topk", """
WITH whole AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)])::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
""")(lambda spark, folder: exact_topk.search(table(spark, folder, "embeddings")))


# --- 2: secret scans ------------------------------------------------------------

def _spans_sql(rules: tuple) -> str:
    parts = []
    for rank, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        parts.append(
            f"SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, regexp_extract_all(t, '{pattern}', 0) AS m, "
            f"string_split_regex(t, '{pattern}') AS gap, regexp_extract_all(t, '{pattern}', {r.value}) AS v, "
            f"{r.least} AS least FROM texts WHERE regexp_matches(t, '{secret_ledger.probe(r).replace(chr(39), chr(39) * 2)}')"
        )
    return " UNION ALL ".join(parts)


def _joined_sql(condition: str) -> str:
    return (
        "COALESCE(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) "
        f"FILTER (WHERE {condition}), '')"
    )


query("op2_secret_ledger", f"""
WITH texts AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
found AS ({_spans_sql(secret_ledger.RULES)}),
each AS (
  SELECT doc_id, rank, kind, least, unnest(range(1, len(m) + 1)) AS i, m, gap, v FROM found WHERE len(m) > 0
),
placed AS (
  SELECT doc_id, rank, kind, least, length(v[i]) AS n, length(m[i]) AS w,
    SUM(length(gap[i]) + length(m[i])) OVER (PARTITION BY doc_id, rank ORDER BY i)::BIGINT AS b
  FROM each
),
spans AS (SELECT doc_id, rank, kind, b - w AS a, b FROM placed WHERE n >= least)
SELECT d.doc_id,
  COUNT(*) FILTER (WHERE kind = 'assign') AS n_assign, COUNT(*) FILTER (WHERE kind = 'access') AS n_access,
  COUNT(*) FILTER (WHERE kind = 'hex') AS n_hex,
  sha256({_joined_sql(f"rank < {len(secret_ledger.BASE)}")}) AS base_sha256,
  {_joined_sql("kind IS NOT NULL")} AS spans
FROM documents d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id
""")(lambda spark, folder: _secrets(spark, folder))


def _secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs, ledger = table(spark, folder, "documents"), scratch_path(spark, "ledger")
    secret_ledger.scan_increment(docs, ledger, "first")
    return secret_ledger.digest(secret_ledger.findings(docs, ledger))


# --- 3: language-model scores --------------------------------------------------------

@query("op3_lattice_lm")
def _lm(spark: SparkSession, folder: str) -> DataFrame:
    held_out = language_id.held_out(F.col("doc_id"), 10, 0)
    return lm_scoring.score(table(spark, folder, "documents"), ~held_out).withColumn("held_out", held_out)


# --- 4: near duplicates ----------------------------------------------------------

def words_sql(column: str = "text") -> str:
    """Lower-cased words; only A-Z change."""
    letters = "".join(map(chr, range(65, 91)))
    return f"regexp_extract_all(translate({column}, '{letters}', '{letters.lower()}'), '[^\x20\x09-\x0D]+')"


query("op4_minhash_near_dups", f"""
WITH RECURSIVE words AS (SELECT doc_id, COALESCE({words_sql()}, []) AS w FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]) END AS s FROM words
),
items AS (SELECT doc_id, unnest(s) AS item FROM shingled),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, COUNT(*) AS common FROM items a JOIN items b USING (item)
  WHERE a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT u, v FROM pairs JOIN shingled x ON x.doc_id = u JOIN shingled y ON y.doc_id = v
  WHERE 100 * common >= 85 * (len(x.s) + len(y.s) - common)
),
paths AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(id, to_) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.id, b.v FROM reach r JOIN paths b ON b.u = r.to_
),
low AS (SELECT id, MIN(to_) AS component_id FROM reach GROUP BY id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM shingled s JOIN low ON low.id = s.doc_id
""")(lambda spark, folder: near_dups.digest(
    near_dups.near_duplicates(table(spark, folder, "documents"), k=3, least=85)
))


# --- 5: repeated passages ------------------------------------------------------------------

query("op5_passage_dedup")(lambda spark, folder: passage_dups.repeated_passages(table(spark, folder, "documents")))


# --- 6: token counts -------------------------------------------------------------------

@query("op6_token_rollup")
def _rollup(spark: SparkSession, folder: str) -> DataFrame:
    rollup = scratch_path(spark, "rollup")
    counted = token_rollup.count_tokens(table(spark, folder, "documents"), [token_rollup.read_tokenizer("byte_bpe_50k")])
    token_rollup.commit(token_rollup.insertions(counted), rollup, "documents")
    return token_rollup.totals(spark, rollup)


# --- 7: quality ---------------------------------------------------------------------------

query("op7_quality_pu")(lambda spark, folder: quality_pu.digest(quality_pu.score(
    table(spark, folder, "documents"), table(spark, folder, "labels"), ~language_id.held_out(F.col("doc_id"), 3, 1)
)))


# --- 8: benchmark decontamination ----------------------------------------------------

query("op8_bm25_decontamination")(lambda spark, folder: decontaminate.find_items(
    table(spark, folder, "documents"), table(spark, folder, "benchmark")
))


# --- 9: language identification -----------------------------------------------------

query("op9_language_id")(lambda spark, folder: language_id.digest(
    language_id.identify(table(spark, folder, "documents"), keep=["doc_id"])
))


# --- 10: mixing sources -----------------------------------------------------------

def _mix_sql() -> str:
    rounds = []
    for i in range(mixture.ROUNDS):
        spent = " - ".join(["l.budget", *[
            f"COALESCE((SELECT SUM(size) FROM pick{j} p WHERE p.source IS NOT DISTINCT FROM l.source), 0)" for j in range(i)
        ]])
        unused = " ".join(
            f"AND NOT EXISTS (SELECT 1 FROM pick{j} p WHERE p.source IS NOT DISTINCT FROM r.source AND p.hash = r.hash)"
            for j in range(i)
        )
        rounds.append(f"""
budget{i} AS (SELECT source, {spent} AS budget FROM plan l),
run{i} AS (
  SELECT r.source, r.hash, r.size, b.budget, SUM(r.size) OVER (PARTITION BY r.source ORDER BY r.hash) AS reach
  FROM rows_ r JOIN budget{i} b ON b.source IS NOT DISTINCT FROM r.source
  WHERE r.size > 0 AND r.size <= b.budget {unused}
),
pick{i} AS (SELECT source, hash, size FROM run{i} WHERE reach <= budget)""")
    picks = " UNION ALL ".join(f"SELECT source, hash FROM pick{i}" for i in range(mixture.ROUNDS))
    return rf"""
WITH rows_ AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '{mixture.WORD}')), 0)::BIGINT AS size,
    md5('17:' || COALESCE(doc_id::VARCHAR, '')) AS hash FROM documents
),
sizes AS (SELECT source, SUM(size)::BIGINT AS source_size FROM rows_ GROUP BY source),
weighed AS (
  SELECT *, 1 + (ROW_NUMBER() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS w FROM sizes
),
steps AS (
  SELECT *, SUM(source_size) OVER () AS total,
    COALESCE(SUM(3 * source_size) OVER (ORDER BY source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
    SUM(w) OVER (ORDER BY source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM weighed
),
judged AS (
  SELECT *, (total - stopped)::DOUBLE / weight_left::DOUBLE AS unit,
    w * ((total - stopped)::DOUBLE / weight_left::DOUBLE) > 3 * source_size AS over FROM steps
),
targets AS (
  SELECT source, source_size, CASE WHEN over THEN 3.0::DOUBLE * source_size
    ELSE w * (SELECT (first(total) - COALESCE(SUM(3 * source_size) FILTER (WHERE over), 0))::DOUBLE / (SUM(w) FILTER (WHERE NOT over))::DOUBLE FROM judged) END AS target
  FROM judged
),
plan AS (
  SELECT source, source_size, target,
    CASE WHEN source_size > 0 THEN LEAST(3, floor(target / source_size + 1e-9))::BIGINT ELSE 0 END AS passes,
    round(CASE WHEN source_size > 0 THEN GREATEST(0, target - LEAST(3, floor(target / source_size + 1e-9)) * source_size) ELSE 0 END, 3) AS budget
  FROM targets
),
{",".join(rounds)},
picks AS (SELECT DISTINCT source, hash FROM ({picks}))
SELECT r.doc_id, r.source, r.size, p.source_size, p.target,
  (r.size * (p.passes + CASE WHEN k.hash IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM rows_ r JOIN plan p ON p.source IS NOT DISTINCT FROM r.source
LEFT JOIN picks k ON k.source IS NOT DISTINCT FROM r.source AND k.hash = r.hash
"""


query("op10_source_mix", _mix_sql())(lambda spark, folder: mixture.mix(table(spark, folder, "documents")))


# --- 13: filter interaction audit ------------------------------------------------------

def _audit_sql() -> str:
    word = "'[^\x20\x09-\x0D]+'"
    bits = ", ".join(f"('{letter}', {1 << i})" for i, letter in enumerate(filter_audit.LETTERS))
    symbols = filter_audit.SYMBOLS.decode()
    return f"""
WITH d AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS t FROM documents),
f AS (
  SELECT doc_id, part, t, len(regexp_extract_all(t, {word})) AS n_words,
    len(list_distinct(regexp_extract_all(t, {word}))) AS n_distinct,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals, length(t) AS n_code_points,
    regexp_matches(t, '[{symbols}]') AS symbol
  FROM d
),
least_ AS (SELECT t, MIN(doc_id) AS least FROM d GROUP BY t),
lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT f.part,
    CASE WHEN n_words < {filter_audit.MIN_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * n_distinct < 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 2 * n_code_points THEN 4 ELSE 0 END + CASE WHEN symbol THEN 8 ELSE 0 END
    + CASE WHEN f.doc_id > least_.least THEN 16 ELSE 0 END AS mask,
    COALESCE(lab.good, false) AS good, COALESCE(lab.toxic, false) AS toxic
  FROM f JOIN least_ USING (t) LEFT JOIN lab ON lab.doc_id = f.doc_id
),
hist AS (SELECT part, mask, COUNT(*) AS n, COUNT(*) FILTER (WHERE good) AS good, COUNT(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY ALL),
letters(l, bit) AS (VALUES {bits}),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps AS (
  SELECT filter_order, step::INTEGER AS step, bits[step] AS bit, COALESCE(list_sum(bits[1:step - 1]), 0) AS earlier
  FROM orders, range(1, 6) r(step)
),
parts AS (SELECT DISTINCT part FROM d),
counted AS (
  SELECT p.part, s.filter_order, s.step, s.bit,
    COALESCE(SUM(n) FILTER (WHERE mask & (s.earlier | s.bit) = 0), 0)::BIGINT AS kept,
    COALESCE(SUM(n) FILTER (WHERE mask & s.bit <> 0 AND mask & s.earlier = 0), 0)::BIGINT AS removed,
    COALESCE(SUM(n) FILTER (WHERE mask & s.bit <> 0 AND mask & s.earlier <> 0), 0)::BIGINT AS redundant,
    COALESCE(SUM(n) FILTER (WHERE mask = s.bit), 0)::BIGINT AS unique_fails,
    COALESCE(SUM(good) FILTER (WHERE mask & s.bit <> 0 AND mask & s.earlier = 0), 0)::BIGINT AS good_lost,
    COALESCE(SUM(toxic) FILTER (WHERE mask & s.bit <> 0 AND mask & s.earlier = 0), 0)::BIGINT AS toxic_lost
  FROM parts p CROSS JOIN steps s LEFT JOIN hist h ON h.part = p.part GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  SUM(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM counted
"""


query("op13_filter_audit", _audit_sql())(lambda spark, folder: filter_audit.audit(
    table(spark, folder, "documents"), table(spark, folder, "labels")
))


# --- 12: centroid clustering --------------------------------------------------------

def _clusters_sql() -> str:
    d, k = centroids.DIMENSIONS, centroids.CLUSTERS
    distance = f"list_sum([(x.v[i] - c.v[i]) * (x.v[i] - c.v[i]) for i in range(1, {d + 1})])"
    steps = [f"""
kept AS (
  SELECT ROW_NUMBER() OVER () AS r, vec_id, [floor({centroids.SCALE} * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {d} AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
c0 AS (
  SELECT (ROW_NUMBER() OVER (ORDER BY sha256('{centroids.SEED_PREFIX}' || vec_id::VARCHAR), v) - 1)::INTEGER AS c, v
  FROM kept WHERE vec_id IS NOT NULL QUALIFY c < {k}
)"""]
    for i in range(centroids.ROUNDS):
        steps.append(f"""
a{i} AS (SELECT x.r, x.v, MIN({distance} * 64 + c.c) AS best FROM kept x, c{i} c GROUP BY x.r, x.v),
u{i} AS (
  SELECT (best % 64)::INTEGER AS c, i, floor(SUM(v[i])::DOUBLE / COUNT(*))::BIGINT AS x FROM a{i}, range(1, {d + 1}) t(i) GROUP BY ALL
),
n{i} AS (SELECT c, list(x ORDER BY i) AS v FROM u{i} GROUP BY c),
c{i + 1} AS (SELECT c{i}.c, COALESCE(n{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN n{i} USING (c))""")
    last = f"c{centroids.ROUNDS}"
    return f"""
WITH {",".join(steps)},
fin AS (SELECT x.r, x.vec_id, MIN({distance} * 64 + c.c) AS best FROM kept x, {last} c GROUP BY x.r, x.vec_id),
out_ AS (SELECT vec_id, (best % 64)::INTEGER AS cluster, (best // 64)::BIGINT AS distance FROM fin)
SELECT o.vec_id, o.cluster, o.distance, SUM(o.distance) OVER (PARTITION BY o.cluster)::BIGINT AS cluster_inertia,
  SUM(o.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM out_ o JOIN {last} f ON f.c = o.cluster
"""


@query("op12_vp_tree_kmeans", _clusters_sql())
def _clusters(spark: SparkSession, folder: str) -> DataFrame:
    assigned, final = centroids.cluster(table(spark, folder, "embeddings"))
    return centroids.summary(assigned, final)


# --- 11: toxicity ------------------------------------------------------------------------

@query("op11_toxic_segments")
def _toxic(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = language_id.held_out(F.col("doc_id"), 4, 2)
    found = toxicity.score(docs, toxicity.learn(docs, labels, ~held_out))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_passages", "passages",
    )
