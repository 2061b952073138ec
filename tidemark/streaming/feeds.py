"""Feeds as streams: every file is taken once, progress lives in a checkpoint."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import col
from tidemark.operators.dedup import latest
from tidemark.sinks.places import delete_path, fresh_folder
from tidemark.sinks.tables import ParquetTable


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = "csv",
    pattern: str | None = None,
    files_per_batch: int | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """A folder of files as a stream. The source remembers paths: a file rewritten
    in place is not read again (the batch feed's fingerprints do notice it)."""
    reader = spark.readStream.format(format).schema(schema).options(**(options or {}))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def without_repeats(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of each other; the state
    kept is bounded by the watermark."""
    clock = "__event_time"  # watermarks need a zoned timestamp
    timed = stream.withColumn(clock, col(event_time).cast("timestamp")).withWatermark(clock, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop(clock)


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write everything available now as parquet files and stop. The file sink's
    log makes this exactly-once, whatever is retried."""
    return (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def upsert(
    stream: DataFrame, table: ParquetTable, keys: Sequence[str], newest_by: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Merge everything available now into the table, newest row per key. A batch
    that is replayed after a failure changes nothing, and rows arriving late do not
    undo newer ones."""

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = fresh_folder(spark, f"batch-{batch_id}")
        latest(batch, keys, newest_by).write.parquet(folder)
        source = spark.read.parquet(folder)
        if not table.exists():
            table.ensure_database()
            table.create(source.schema)
        table.merge(source, keys, newer_by=newest_by, keys_verified=True)
        delete_path(spark, folder)

    return (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
