"""Intermediate tables on storage that every executor and the driver share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_MADE: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(remove_all)
    _MADE.append((spark, path))
    return path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Store ``df`` as Parquet and read it back, which cuts its lineage.

    Lost executors then recompute from these files. They are removed when the
    application ends, because a returned query may still read them.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000, size: int | None = None) -> Iterator[None]:
    """Send at most so many rows, and about so many bytes, at a time to Python, for what is run inside the block."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {name: spark.conf.get(name) for name, value in wanted.items() if value is not None}
    for name in before:
        spark.conf.set(name, str(wanted[name]))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def remove_all() -> None:
    """Delete the tables made so far; called at exit, and by tests."""
    while _MADE:
        spark, path = _MADE.pop()
        context = spark.sparkContext
        if context._jsc is None or context._jsc.sc().isStopped():
            continue
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
