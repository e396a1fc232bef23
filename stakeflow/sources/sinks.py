"""Sinks: views, keyed upserts, merges, clustered writes.

The ``*_rows`` functions are pure: they return what the target becomes. The
writers apply them to Parquet, rewriting only the partitions a batch touches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stakeflow.functions.keys import with_audit


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def align_schema(target: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the target's columns first and the batch's new ones appended."""
    added = [f for f in batch.schema.fields if f.name not in target.columns]
    wide_target = target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added})
    absent = [f for f in target.schema.fields if f.name not in batch.columns]
    wide_batch = batch.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    return wide_target, wide_batch.select(*wide_target.columns)


def replace_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete target rows whose key is in the batch, then insert the batch."""
    target, batch = align_schema(target, batch)
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch)


def merge_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], update_cols: Sequence[str]
) -> DataFrame:
    """Update the listed columns of matching rows and insert the others."""
    target, batch = align_schema(target, batch)
    columns = target.columns
    stacked = target.withColumn("_new", F.lit(False)).unionByName(
        batch.withColumn("_new", F.lit(True))
    )
    # One row per key and side, so both sides meet in a single grouped pass.
    row = F.struct(*columns)
    met = stacked.groupBy(*keys).agg(
        F.first(F.when(~F.col("_new"), row), ignorenulls=True).alias("_old"),
        F.first(F.when(F.col("_new"), row), ignorenulls=True).alias("_fresh"),
    )
    merged = []
    for c in columns:
        old, fresh = F.col(f"_old.{c}"), F.col(f"_fresh.{c}")
        if c in update_cols:
            merged.append(F.when(F.col("_fresh").isNotNull(), fresh).otherwise(old).alias(c))
        else:
            merged.append(F.when(F.col("_old").isNotNull(), old).otherwise(fresh).alias(c))
    return met.select(*merged)


def pruned_replace_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], range_col: str
) -> DataFrame:
    """The rewritten slice of the target: rows within the batch's range of ``range_col``.

    The bounds come from one aggregate on the batch and enter the plan as
    literals, so the target scan is pruned. A key outside the range is not seen.
    """
    low, high = batch.agg(F.min(range_col), F.max(range_col)).first()
    within = target.filter(F.col(range_col).between(F.lit(low), F.lit(high)))
    return replace_rows(within, batch, keys)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of shared storage, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


SCHEMA_FILE = "_schema.json"  # Spark skips names that start with an underscore


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table with all columns it ever got, or None when there is none.

    Older partitions may lack columns added later. The current schema is kept in a
    small file, which spares a scan of every footer.
    """
    if not exists(spark, path):
        return None
    fs, p = _fs(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    if not fs.exists(p):
        return spark.read.parquet(path)
    stream = fs.open(p)
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return spark.read.schema(T.StructType.fromJson(json.loads(text))).parquet(path)


def _keep_schema(df: DataFrame, path: str) -> None:
    fs, p = _fs(df.sparkSession, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    stream = fs.create(p, True)
    stream.write(bytearray(df.schema.json().encode()))
    stream.close()


def write_clustered(
    df: DataFrame, path: str, partition: str | None = None, cluster_by: Sequence[str] = (),
    mode: str = "overwrite", files: int | None = None,
) -> None:
    """Write Parquet laid out for pruning.

    ``partition`` becomes directories; rebalancing gives a large day several files
    and a small one a single file. ``cluster_by`` sorts rows, by range over the
    whole table where there are no directories, so that file and row-group
    statistics prune scans.
    """
    out = df
    if partition:
        out = out.hint("rebalance", F.col(partition))
        if cluster_by:
            out = out.sortWithinPartitions(partition, *cluster_by)
    elif cluster_by:
        out = out.repartitionByRange(*([files] if files else []), *cluster_by)
        out = out.sortWithinPartitions(*cluster_by)
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(path)
    _keep_schema(df, path)


def swap_in(df: DataFrame, path: str, cluster_by: Sequence[str] = (), partition: str | None = None) -> None:
    """Write next to ``path`` and rename over it; readers never see a partial table."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}__staged_{uuid.uuid4().hex}"
    write_clustered(df, staged, partition, cluster_by)
    fs, live = _fs(spark, path)
    _, fresh = _fs(spark, staged)
    if fs.exists(live):
        _, old = _fs(spark, f"{path.rstrip('/')}__old_{uuid.uuid4().hex}")
        if not fs.rename(live, old):
            raise OSError(f"cannot move {path} aside")
        if not fs.rename(fresh, live):
            fs.rename(old, live)
            raise OSError(f"cannot publish {staged}")
        fs.delete(old, True)
    elif not fs.rename(fresh, live):
        raise OSError(f"cannot publish {staged}")
    spark.catalog.refreshByPath(path)


def _values(df: DataFrame, partition: str) -> list:
    # Partition values (days or epochs), not rows.
    return [r[0] for r in df.select(partition).distinct().collect()]


def _drop_partitions(spark: SparkSession, path: str, partition: str, values) -> None:
    for value in values:
        fs, p = _fs(spark, f"{path.rstrip('/')}/{partition}={value}")
        if fs.exists(p):
            fs.delete(p, True)


def upsert_replace(
    spark: SparkSession, path: str, batch: DataFrame, key: str | Sequence[str],
    partition: str | None = None, cluster_by: Sequence[str] = (), audit: bool = True, moves: bool = True,
) -> None:
    """Delete+insert into a Parquet target, rewriting only the partitions concerned.

    Those are the batch's partitions and, as a key may have moved, the partitions that hold
    one of its keys now; finding them reads the key column of the target. ``moves=False`` spares that
    where the partition is part of the key. The batch is written once to a staging path first, so
    that its partitions and its rows come from the same evaluation. A first load into directories evaluates
    the batch only once and is written where it belongs.
    """
    keys = [key] if isinstance(key, str) else list(key)
    target = read_target(spark, path)
    stamped = with_audit(batch) if audit else batch
    if target is None and partition is not None:
        swap_in(stamped, path, cluster_by, partition)
        return
    staged_path = f"{path.rstrip('/')}__batch_{uuid.uuid4().hex}"
    stamped.write.parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    try:
        if target is None:
            swap_in(staged, path, cluster_by, partition)
        elif partition is None:
            swap_in(replace_rows(target, staged, keys), path, cluster_by)
        else:
            values = _values(staged, partition)
            emptied = set()
            if moves:
                moved = staged.select(*keys).distinct()
                held = target.select(*keys, partition)
                # Only partitions that the batch has no rows for can be left empty.
                emptied = {*_values(held.join(moved, keys, "left_semi"), partition)} - {*values}
                values = sorted({*values, *emptied}, key=str)
                if emptied:
                    stay = held.filter(F.col(partition).isin([*emptied])).join(moved, keys, "left_anti")
                    emptied -= {*_values(stay, partition)}
            slice_ = target.filter(F.col(partition).isin(values))
            write_clustered(replace_rows(slice_, staged, keys), path, partition, cluster_by)
            _drop_partitions(spark, path, partition, emptied)
        spark.catalog.refreshByPath(path)
    finally:
        fs, p = _fs(spark, staged_path)
        fs.delete(p, True)


def replace_partitions(
    spark: SparkSession, path: str, batch: DataFrame, partition: str,
    cluster_by: Sequence[str] = (), audit: bool = True, covered: Sequence = (),
) -> None:
    """Replace every partition present in the batch as a whole.

    ``covered`` lists partition values the batch accounts for; those it has no rows
    for are removed.
    """
    staged_path = f"{path.rstrip('/')}__batch_{uuid.uuid4().hex}"
    (with_audit(batch) if audit else batch).write.parquet(staged_path)
    try:
        staged = spark.read.parquet(staged_path)
        target = read_target(spark, path)
        if target is not None:
            staged = align_schema(target, staged)[1]
        write_clustered(staged, path, partition, cluster_by)
        if covered:
            held = {str(v) for v in _values(staged, partition)}
            _drop_partitions(spark, path, partition, [v for v in covered if str(v) not in held])
        spark.catalog.refreshByPath(path)
    finally:
        fs, p = _fs(spark, staged_path)
        fs.delete(p, True)


def upsert_pruned(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition: str,
    cluster_by: Sequence[str] = (),
) -> None:
    """Delete+insert within the batch's range of the partition column; keys outside the range are not seen.

    Only the partitions inside the range are read and rewritten.
    """
    staged_path = f"{path.rstrip('/')}__batch_{uuid.uuid4().hex}"
    with_audit(batch).write.parquet(staged_path)
    try:
        staged = spark.read.parquet(staged_path)
        target = read_target(spark, path)
        if target is None:
            swap_in(staged, path, cluster_by, partition)
        else:
            write_clustered(pruned_replace_rows(target, staged, keys, partition), path, partition, cluster_by)
        spark.catalog.refreshByPath(path)
    finally:
        fs, p = _fs(spark, staged_path)
        fs.delete(p, True)


def merge_upsert(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
    update_cols: Sequence[str], cluster_by: Sequence[str] = (),
) -> None:
    """Merge on a composite key; ``inserted_timestamp`` of matched rows is kept.

    Only the files that hold a key of the batch are rewritten. They are found by a scan of the key columns with
    ``_metadata.file_path``, semi-joined with the batch's keys, so what reaches the driver is a list of file names.
    Their rows are merged with the batch and written as new files, and then the old files are deleted; every
    other file keeps its name and contents. Rows of the batch with a new key go into the new files.
    """
    target = read_target(spark, path)
    stamped = with_audit(batch)
    if target is None:
        swap_in(stamped, path, cluster_by)
        return
    staged_path = f"{path.rstrip('/')}__batch_{uuid.uuid4().hex}"
    merged_path = f"{path.rstrip('/')}__merged_{uuid.uuid4().hex}"
    stamped.write.parquet(staged_path)
    try:
        staged = spark.read.parquet(staged_path)
        touched = [r[0] for r in target.select(*keys, F.col("_metadata.file_path").alias("_file")).join(
            staged.select(*keys).distinct(), list(keys), "left_semi"
        ).select("_file").distinct().collect()]
        old = spark.read.schema(target.schema).parquet(*touched) if touched else target.limit(0)
        merged = merge_rows(old, staged, keys, [*update_cols, "modified_timestamp"])
        write_clustered(merged, merged_path, None, cluster_by)
        fs, live = _fs(spark, path)
        made, _ = _fs(spark, merged_path)
        for status in made.listStatus(_fs(spark, merged_path)[1]):
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            moved = _fs(spark, f"{path.rstrip('/')}/merged-{uuid.uuid4().hex}-{name}")[1]
            if not fs.rename(status.getPath(), moved):
                raise OSError(f"cannot move {name} into {path}")
        for file in touched:
            gone, p = _fs(spark, file)
            gone.delete(p, False)
        if len(merged.columns) > len(target.columns):
            _keep_schema(merged, path)
        spark.catalog.refreshByPath(path)
    finally:
        for leftover in (staged_path, merged_path):
            fs, p = _fs(spark, leftover)
            fs.delete(p, True)
