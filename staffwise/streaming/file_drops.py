"""Incremental pick-up of landed extract files.

The source jobs reload whatever files were dropped into a folder.  Here the
folder is a Structured Streaming file source: each run (``availableNow``
trigger, e.g. from a daily scheduler) processes only files not seen before,
hands them to a batch transform through ``foreachBatch``, and appends the
result.  Progress is kept in a folder that the caller names and that every run
must be given again: the next run is another application, so a folder made
for one application would forget which files were read.  ``foreachBatch`` itself is only
at-least-once (a batch whose output was written but not yet committed to the
checkpoint is run again), so each batch overwrites its own ``batch_id=<n>``
folder of the sink: a replayed batch replaces its earlier output instead of
adding to it.  There are no watermarks or state: the extracts are complete
snapshots, not event streams.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def write_epoch(df: DataFrame, epoch_id: int, sink_path: str, partition_by: Sequence[str] = ()) -> None:
    """Write one micro-batch idempotently: overwrite ``sink_path/batch_id=<epoch_id>``.
    Reading ``sink_path`` as parquet yields every batch once, with ``batch_id``
    as a partition column."""
    out = df.write.mode("overwrite")
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(f"{sink_path.rstrip('/')}/batch_id={int(epoch_id)}")


def ingest_file_drops(spark: SparkSession, source_dir: str, schema: T.StructType | str, sink_path: str,
                      progress_path: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                      fmt: str = "csv", options: Mapping[str, str] | None = None,
                      partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Start one incremental run over the files not yet processed; returns the
    query (call ``awaitTermination()``).  ``progress_path`` is one fixed folder
    on shared storage per sink, kept from run to run."""
    reader = spark.readStream.schema(schema).format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        write_epoch(transform(batch), epoch_id, sink_path, partition_by)

    return (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", progress_path)
            .trigger(availableNow=True).start())
