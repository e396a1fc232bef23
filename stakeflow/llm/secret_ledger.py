"""Secret scans through a ledger of content-addressed blobs.

Every version of a text is addressed by the SHA-256 of its content. A blob is scanned
once per rule version: pairs the ledger holds already are left out, and findings are
joined back to every path that has the blob, now or in any earlier increment.

Ledger: Parquet below ``<ledger>/batch=<name>``, one row per blob and increment, with the
rule versions applied to it and the spans they gave. Committing a batch again replaces it.

Cases: NULL text reads as empty; repeated rows and copies share one blob and each keep
their own result row; other columns of the input, whatever their names, are carried
along untouched except for those named as results; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


class Rule(NamedTuple):
    """``value`` is the group whose length must reach ``least``; 0 is the whole match."""

    kind: str
    pattern: str
    value: int
    least: int
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base patterns with their least lengths, in the order that breaks ties.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Published token formats that the base patterns do not name.
EXTRA = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 20),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("url_login", r"[a-z][a-z0-9+]{1,9}://([^\s/:@]+):([^\s/:@]+)@", 2, 3),
)
RULES = BASE + EXTRA
SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string>"
LEDGER_SPAN = SPAN.replace(">", ",version:int>")
LEDGER = f"blob_id string, rules array<string>, spans array<{LEDGER_SPAN}>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _pieces(text: Column, rule: Rule, rank: int) -> Column:
    """Matches of a rule in order: the length of the gap before each, its own, whether it counts.

    The gaps are what a split by the pattern leaves, so starts are running sums of lengths.
    A rule without a long enough run of its characters costs one search and no more.
    """
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"),
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(rule.value)).alias("v"),
    )
    listed = F.transform(found, lambda z, i: F.struct(
        F.lit(rank).alias("rank"), i.alias("pos"),
        F.char_length(z["gap"]).cast("long").alias("gap"), F.char_length(z["m"]).cast("long").alias("len"),
        (F.char_length(z["v"]) >= rule.least).alias("ok"),
    ))
    return F.when(text.rlike(probe(rule)), F.filter(listed, lambda p: p["len"].isNotNull()))


def probe(rule: Rule) -> str:
    """A search that finds something wherever the rule keeps a match."""
    if rule.value == 0 and rule.pattern.endswith("]+") and rule.pattern.count("]+") == 1:
        fixed = rule.pattern[:rule.pattern.rindex("[")]
        return f"{rule.pattern[:-1]}{{{max(1, rule.least - len(fixed))},}}"
    return rule.pattern


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Apply to each row of (blob_id, text, todo) the rules whose keys ``todo`` lists; rows of LEDGER.

    Everything happens in the partition that holds the blob: the running sums are
    partitioned by blob, as the blobs are already.
    """
    every = [
        F.coalesce(
            F.when(F.array_contains("todo", rule.key), _pieces(F.col("text"), rule, i)),
            F.array().cast("array<struct<rank:int,pos:int,gap:bigint,len:bigint,ok:boolean>>"),
        )
        for i, rule in enumerate(rules)
    ]
    found = blobs.select("blob_id", "todo", F.explode_outer(F.flatten(F.array(*every))).alias("p"))
    each = found.select("blob_id", "todo", "p.*")
    so_far = Window.partitionBy("blob_id", "rank").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(so_far)
    kinds, versions = (F.array(*[F.lit(x) for x in xs]) for xs in zip(*[(r.kind, r.version) for r in rules]))
    span = F.struct(
        (F.col("end") - F.col("len")).alias("start"), "rank", "end", F.get(kinds, F.col("rank")).alias("kind"),
        F.get(versions, F.col("rank")).alias("version"),
    )
    return each.withColumn("end", end).groupBy("blob_id").agg(
        F.first("todo").alias("rules"),
        F.array_sort(F.collect_list(F.when(F.col("ok"), span))).cast(f"array<{LEDGER_SPAN}>").alias("spans"),
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All committed rows; none where the ledger does not exist yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{LEDGER}, batch string")
    return spark.read.schema(f"{LEDGER}, batch string").parquet(ledger)


def scan_increment(
    versions: DataFrame, ledger: str, batch: str, text: str = "text", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Scan the unseen (blob, rule version) pairs of ``versions``, commit them as ``batch``, return the batch.

    Copies are reduced to one blob before the shuffle. A batch name is a path part.
    """
    spark = versions.sparkSession
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    blobs = versions.select(blob_id(content).alias("blob_id"), content.alias("text")).groupBy("blob_id").agg(
        F.first("text").alias("text")
    )
    wanted = F.array(*[F.lit(r.key) for r in rules])
    held = read_ledger(spark, ledger).filter(F.col("batch") != batch)
    if held.isEmpty():
        todo = blobs.withColumn("todo", wanted)
    else:
        seen = held.groupBy("blob_id").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        todo = blobs.join(seen, "blob_id", "left").select(
            "blob_id", "text",
            F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"),
        ).filter(F.size("todo") > 0)
    target = f"{ledger.rstrip('/')}/batch={batch}"
    scan_blobs(todo, rules).write.mode("overwrite").parquet(target)
    return spark.read.schema(LEDGER).parquet(target)


def _rule_key(span: Column) -> Column:
    """kind@version; the version of a span stored without one is that of its row's rule of the kind."""
    of_row = F.get(F.filter("rules", lambda r: r.startswith(F.concat(span["kind"], F.lit("@")))), F.lit(0))
    return F.coalesce(F.concat(span["kind"], F.lit("@"), span["version"].cast("string")), of_row)


def _known(rules: tuple[Rule, ...]) -> Column:
    """Spans of a ledger row that one of the rules gave, in its own version."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    return F.filter("spans", lambda s: F.array_contains(keys, _rule_key(s)))


def findings(versions: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` with ``spans``: what the ledger holds, under the given rules, for each row's blob.

    Only blobs with a finding are joined; spans are ordered by start, then by rule.
    """
    spark = versions.sparkSession
    ranks = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    placed = F.transform(_known(rules), lambda s: F.struct(
        s["start"].alias("start"), ranks[_rule_key(s)].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
    ))
    found = read_ledger(spark, ledger).filter(F.size("spans") > 0).groupBy("blob_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(placed)))).alias("spans")
    ).withColumnRenamed("blob_id", "found_blob")
    kept = versions.drop("spans")
    addressed = kept.withColumn("__blob", blob_id(kept[text].cast("string")))
    return addressed.join(found, F.col("__blob") == F.col("found_blob"), "left").select(
        *[addressed[c] for c in kept.columns], F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")
    )


def without_findings(
    versions: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """The rows of ``versions`` whose blob has no finding in the ledger, under the given rules."""
    found = read_ledger(versions.sparkSession, ledger).filter(F.size(_known(rules)) > 0).select(F.col("blob_id").alias("__blob")).distinct()
    addressed = versions.withColumn("__blob", blob_id(versions[text].cast("string")))
    return addressed.join(found, "__blob", "left_anti").select(*[addressed[c] for c in versions.columns])


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digest(found: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Counts per base kind, a hash of the base spans, and all spans as text."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    plain = F.filter("spans", lambda s: F.array_contains(F.array(*[F.lit(r.kind) for r in base]), s["kind"]))
    return found.select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in base],
        F.sha2(joined(plain), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
