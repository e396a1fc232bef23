"""Run registered queries next to their SQL: python -m verification.compare [folder] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

from stakeflow.session import local_session
from verification.registry import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


# DuckDB type of each Spark type, for the types the queries return.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def type_gaps(mine: dict[str, str], theirs: dict[str, str]) -> dict[str, tuple[str, str]]:
    same = {c: SAME_TYPE.get(t, t.upper()) for c, t in mine.items()}
    return {c: (mine[c], theirs[c]) for c in mine if same[c] != theirs[c].replace(", ", ",")}


def compare(spark, con, folder: str, name: str) -> str:
    df = QUERIES[name](spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return f"rows only: {sum(mine.values())}"
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    theirs = rows_of(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return f"COLUMNS differ: {sorted(set(cols) ^ set(df.columns))}"
    kinds = type_gaps(dict(df.dtypes), {d[0]: str(d[1]) for d in cur.description})
    if mine == theirs:
        return f"TYPES differ: {kinds}" if kinds else f"ok {sum(mine.values())} rows"
    only, other = list((mine - theirs).elements()), list((theirs - mine).elements())
    names = sorted(cols)
    note = f"VALUES differ: {len(only)} vs {len(other)} of {sum(mine.values())}/{sum(theirs.values())}"
    if only and other:
        probe = only[0]
        near = max(other, key=lambda r: sum(a == b for a, b in zip(probe, r)))
        note += " e.g. " + str(
            {n: (a, b) for n, a, b in zip(names, probe, near) if a != b} or "same values, other types"
        )
    elif only or other:
        note += " e.g. " + str(dict(zip(names, (only or other)[0])))
    return note


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(QUERIES)
    spark, con = local_session(), connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            outcome = compare(spark, con, folder, name)
        except Exception as e:  # report and go on with the next query
            outcome = f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not outcome.startswith(("ok", "rows only"))
        print(f"{name:45s} {time.time() - start:6.1f}s {outcome}", flush=True)
    print(f"{len(wanted)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
