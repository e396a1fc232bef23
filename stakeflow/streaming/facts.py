"""Event facts fed by a file stream.

The facts are stateless per row, so the batch transform is reused as it is. Each
micro-batch is upserted by key, which makes a replayed batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stakeflow.plans.events import fact
from stakeflow.plans.refresh import MARK, fan_out_facts, store_event_fact, with_mark
from stakeflow.sources.contracts import CONTRACTS


def log_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Event logs arriving as Parquet files, read with their contract's schema."""
    reader = spark.readStream.schema(CONTRACTS["event_logs"])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start_fact(
    logs: DataFrame, target: str, name: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Upsert one event fact into ``target``, as the batch refresh does."""

    def write(batch: DataFrame, _: int) -> None:
        store_event_fact(batch.sparkSession, batch, target, name)

    writer = fact(with_mark(logs), name, keep=[MARK]).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_available(
    spark: SparkSession, source: str, target: str, name: str, checkpoint: str,
    max_files: int | None = None,
) -> None:
    """Process everything that has arrived and stop."""
    start_fact(log_stream(spark, source, max_files), target, name, checkpoint).awaitTermination()


def start_facts(logs: DataFrame, targets: dict[str, str], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Upsert several event facts from one stream: each micro-batch is read once and fanned out by event."""

    def write(batch: DataFrame, _: int) -> None:
        fan_out_facts(batch.sparkSession, batch, targets)

    writer = with_mark(logs).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
