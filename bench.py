"""Benchmark: wall seconds per headline query, one JSON line on stdout.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs after one warm-up, default 1; the median is reported).
Results go to the ``noop`` sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stakeflow.session import local_session  # noqa: E402
from verification.registry import QUERIES  # noqa: E402

HEADLINE = [
    name for name in QUERIES
    if re.match(r"(M\d+|J8|W2|W10|W12|W13|W14|W15|J6|D10|D12|E2|E5)_", name)
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session("stakeflow-bench", cores)

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in wanted:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total wall seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": re.sub(r".*sf", "", folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
