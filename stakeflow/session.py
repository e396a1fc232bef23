"""Session settings the pipelines rely on."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings; everything here can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Several joins feed an aggregate on the join key. Without this setting a
    # skewed partition is left whole there, because splitting it costs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "stakeflow", cores: str = "8", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in a folder the cluster shares: ``spark.checkpoint.dir``, or else the warehouse.

    What is written there is removed when the application ends. Without either setting there is no
    folder that all executors see, and an error is raised.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(_remove)
    _MADE.append((spark, path))
    return path


_MADE: list[tuple[SparkSession, str]] = []


def _remove() -> None:
    while _MADE:
        spark, path = _MADE.pop()
        context = getattr(spark, "sparkContext", None)
        if context is not None and context._jsc is not None and not context._jsc.sc().isStopped():
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
