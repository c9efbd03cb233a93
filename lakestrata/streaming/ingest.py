"""Structured Streaming jobs (K2, K3, ST1-ST5).

* ``run_available`` drains what is available and stops (availableNow); the
  file sink's metadata log makes each file count exactly once across
  re-runs (ST3).
* ``streaming_table`` checks fail rules inside the write of a batch, so a
  broken batch commits nothing, and counts all rules in the same pass; every
  batch is written to its own ``_batch_id=<n>`` partition with overwrite, which
  makes a replayed batch (foreachBatch is at-least-once) idempotent.
* ``dedup_stream`` (ST4) and ``refresh_groups`` (ST5) keep a latest-row table
  and an aggregate table current as runs merged on read (``streaming.runs``):
  a batch writes its own survivors or partial aggregates and commits them,
  with its writer's batch number, in one step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakestrata.operators import expectations as E
from lakestrata.operators.dedup import dedup_latest
from lakestrata.sources.files import is_path, read_csv_files, rescue, resolve_schema, stream_table, with_lineage
from lakestrata.streaming import runs as R

BATCH_COL = "_batch_id"


def run_available(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                  partition_by: Sequence[str] = (), timeout_s: float | None = None) -> StreamingQuery:
    """K2: append everything available to ``path``, a folder or a catalog table's name, once, then stop.

    A table that does not exist is created by the stream.
    """
    w = (df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(path) if is_path(path) else w.toTable(path)
    q.awaitTermination(timeout_s)
    return q


#: Fixed schema of the binaryFile source (only ``path`` is selected, so contents are not read).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def csv_batches(spark: SparkSession, src_dir: str, glob: str | None, checkpoint: str,
                write: Callable[[DataFrame, str], None], max_files_per_trigger: int = 1000,
                timeout_s: float | None = None, declared: Sequence[str] = ()) -> StreamingQuery:
    """Hand every micro-batch of new CSV files to ``write(frame, batch key)``, then stop.

    The stream lists new files; each batch reads its files (at most
    ``max_files_per_trigger``) by header, so added, dropped and reordered
    columns go by name and surplus values stay.
    """
    files = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if glob:
        files = files.option("pathGlobFilter", glob)
    files = files.option("maxFilesPerTrigger", str(max_files_per_trigger)).load(src_dir).select(
        F.col("_metadata.file_path").alias("path"))

    def batch_files(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(unquote(r["path"]) for r in batch.collect())  # bounded by max_files_per_trigger
        if paths:
            write(read_csv_files(spark, paths, declared=declared), batch_key(checkpoint, batch_id))

    q = (files.writeStream.foreachBatch(batch_files).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    return q


def ingest_available(spark: SparkSession, src_dir: str, glob: str | None, target: str, checkpoint: str,
                     schema: T.StructType | None = None, schema_location: str | None = None, infer_types: bool = False,
                     as_of: str | None = None, file_col: str = "source_file", time_col: str = "ingestion_timestamp",
                     max_files_per_trigger: int = 1000) -> StreamingQuery:
    """S2, S3, ST1: new CSV files -> declared columns by name, rescue and lineage -> appended table, then stop.

    Without ``schema`` the saved one at ``schema_location`` holds, or the
    first run's files give it (inferred types, or text). Later columns and
    values that do not fit it go to ``_rescued_data``. Read the table with
    ``read_batches``.
    """
    if schema is None:
        schema = resolve_schema(spark, src_dir, glob, schema_location, infer_types)

    def write(raw: DataFrame, key: str) -> None:
        rows = rescue(with_lineage(raw, None, time_col, as_of).withColumnRenamed("source_file", file_col), schema,
                      keep=(file_col, time_col))
        (rows.withColumn(BATCH_COL, F.lit(key)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(target))

    return csv_batches(spark, src_dir, glob, checkpoint, write, max_files_per_trigger, declared=schema.names)


def transform_stream(spark: SparkSession, src: str, fn: Callable[[DataFrame], DataFrame], dst: str,
                     checkpoint: str, rules: Sequence[E.Rule] = ()) -> StreamingQuery:
    """ST2: stateless transform of a table stream into another table; a broken fail rule stops the batch before its commit."""
    return run_available(E.expect(fn(stream_table(spark, src)), rules), dst, checkpoint)


def batch_key(checkpoint: str, batch_id: int) -> str:
    """Name of a micro-batch: unlike in other checkpoints that write to the same table, alike when it is replayed."""
    return f"{hashlib.sha1(checkpoint.rstrip('/').encode()).hexdigest()[:12]}-{batch_id}"


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a table written by ``streaming_table`` (batch column dropped)."""
    return spark.read.parquet(path).drop(BATCH_COL)


def write_expected(batch: DataFrame, rules: Sequence[E.Rule], target: str, key: str, metrics_path: str | None, table: str) -> None:
    """Write one batch under its key in a single pass: drop rules remove rows, a
    broken fail rule ends the write before its commit, and the counters of all
    rules are observed on the way and stored as metrics rows (E5)."""
    counted, counts = E.observed(batch, rules, f"rules-{key}") if rules else (batch, None)
    known = R.exists(batch.sparkSession, target)
    try:
        (E.expect(counted, rules).withColumn(BATCH_COL, F.lit(key)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COL).parquet(target))
    except Exception:
        if not known:  # the first batch leaves no empty table behind
            R.remove(batch.sparkSession, target)
        raise
    if counts is not None and metrics_path:
        metrics = E.observed_metrics(batch.sparkSession, counts.get, rules, table)
        (metrics.withColumn(BATCH_COL, F.lit(key)).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(metrics_path))


def streaming_table(stream: DataFrame, rules: Sequence[E.Rule], target: str, checkpoint: str,
                    metrics_path: str | None = None, table: str = "table",
                    timeout_s: float | None = None) -> StreamingQuery:
    """K3: streaming table with fail / drop / warn expectations per micro-batch (``write_expected``)."""
    rules = list(rules)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_expected(batch, rules, target, batch_key(checkpoint, batch_id), metrics_path, table)

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    return q


def _writer(checkpoint: str) -> str:
    """A stream's name in the tables that it writes to: that of its checkpoint."""
    return batch_key(checkpoint, 0).split("-")[0]


def _latest(keys: Sequence[str], order: Sequence[Column], ties: Sequence[Column]) -> Callable[[DataFrame], DataFrame]:
    # of rows that tie in everything named, the one stored first stays
    return lambda df: dedup_latest(df, keys, order, [*ties, F.asc(R.AGE_COL)]).drop(R.AGE_COL)


def dedup_stream(stream: DataFrame, keys: Sequence[str], order: Sequence[Column], dst: str, checkpoint: str,
                 ties: Sequence[Column] = (), timeout_s: float | None = None) -> StreamingQuery:
    """ST4: keep the latest row per key current as new rows stream in.

    A batch is cut to its latest row per key and committed as a run: it writes
    bytes in proportion to itself (and, now and then, to the runs that it is
    folded with). ``read_latest`` chooses the latest row over the runs.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            R.append(dedup_latest(batch, keys, order, ties), dst, _writer(checkpoint), batch_id, _latest(keys, order, ties))

    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    return q


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column], ties: Sequence[Column] = ()) -> DataFrame:
    """Batch read of a table kept by ``dedup_stream`` with the same keys, order and ties."""
    return R.read_runs(spark, path, _latest(keys, order, ties))


MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


def _merged(keys: Sequence[str], merge: Mapping[str, str]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.groupBy(*keys).agg(*[MERGES[how](c).alias(c) for c, how in merge.items()])


def refresh_groups(stream: DataFrame, keys: Sequence[str], agg: Callable[[DataFrame], DataFrame], merge: Mapping[str, str],
                   silver: str, gold: str, checkpoint: str, timeout_s: float | None = None) -> StreamingQuery:
    """ST5: append new rows to ``silver`` and bring ``gold`` up to date.

    ``agg(df)`` groups by ``keys`` into columns that can be merged, and
    ``merge`` says how (sum, min or max) for each. A batch is aggregated alone,
    from what it has written to silver, and committed as a run; neither the
    rest of silver nor of gold is read. The commit holds the last batch of each
    writer, so a replayed batch is not added twice, whoever wrote since.
    ``read_groups`` merges the runs.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        key = batch_key(checkpoint, batch_id)
        (batch.withColumn(BATCH_COL, F.lit(key)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COL).parquet(silver))
        own = batch.sparkSession.read.schema(batch.schema).parquet(f"{silver.rstrip('/')}/{BATCH_COL}={key}")
        R.append(agg(own), gold, _writer(checkpoint), batch_id, _merged(keys, merge))

    q = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    return q


def read_groups(spark: SparkSession, path: str, keys: Sequence[str], merge: Mapping[str, str]) -> DataFrame:
    """Batch read of a table kept by ``refresh_groups`` with the same keys and merges."""
    return R.read_runs(spark, path, _merged(keys, merge))
