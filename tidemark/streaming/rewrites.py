"""Feeds whose files may be rewritten in place, as streams.

Spark's file source remembers paths, so it never reads a rewritten file again. Here the
stream is one of listings: each trigger adds a listing of the folder, a keyed state holds
the fingerprint (size and modification time) of every path, and what comes out are the
files that are new or have changed. Their rows replace those the path had before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.columns import plain_path
from tidemark.functions.partitioning import PartitionRule
from tidemark.sinks.places import delete_path, fresh_folder
from tidemark.sinks.tables import ParquetTable
from tidemark.sources import feeds

#: Column of a target that says which file a row is from, and how many buckets of files it has.
FILE = "source_file"
BUCKETS = 64


def target(spark: SparkSession, database: str, table: str, buckets: int = BUCKETS) -> ParquetTable:
    """A table for such a feed: partitioned by buckets of its files, so that a changed file
    rewrites a bucket, not the table."""
    return ParquetTable(spark, database, table, PartitionRule("bucket", FILE, buckets))


def post_listing(spark: SparkSession, path: str, listings: str, pattern: str = "*.csv") -> None:
    """Add a listing of a folder to the folder of listings. Contents are not read."""
    listed = feeds.list_files(spark, path, pattern).select("file_path", "file_size", "last_modified")
    listed.coalesce(1).write.mode("append").parquet(listings)


def changes(spark: SparkSession, listings: str) -> DataFrame:
    """A stream of ``(file_path, file_size, last_modified)`` of files that are new or were
    rewritten since the listing before. A path's state is two values, kept as long as the
    checkpoint: a timeout would keep a stream that stops when all is read from stopping."""

    def compare(key: tuple, found: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # several listings may come at once; the newest modification is the file as it is
        rows = pd.concat(found).sort_values(["last_modified", "file_size"])
        size, modified = int(rows["file_size"].iloc[-1]), str(rows["last_modified"].iloc[-1])
        known = state.getOption
        state.update((size, modified))
        if known is None or tuple(known) != (size, modified):
            yield pd.DataFrame({"file_path": [key[0]], "file_size": [size], "last_modified": [modified]})

    listed = spark.readStream.schema("file_path string, file_size bigint, last_modified string").parquet(listings)
    return listed.groupBy("file_path").applyInPandasWithState(
        compare, "file_path string, file_size bigint, last_modified string", "file_size bigint, last_modified string", "append",
        GroupStateTimeout.NoTimeout)


def ingest(spark: SparkSession, path: str, schema: T.StructType | str, table: ParquetTable, checkpoint: str, listings: str,
           pattern: str = "*.csv", **csv) -> StreamingQuery:
    """List the folder, then bring the table up to the files that are new or changed, and stop.

    The rows of a changed file replace those it had; a batch that is replayed after a failure
    replaces rows by the same ones. Rows that do not fit have NULLs, as ``csv_scan`` gives them.
    """
    post_listing(spark, path, listings, pattern)

    def replace(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        folder = fresh_folder(session, f"changed-{batch_id}")
        batch.write.parquet(f"{folder}/files")
        files = session.read.schema(batch.schema).parquet(f"{folder}/files")
        paths = sorted(r["file_path"] for r in files.select("file_path").collect())  # the reader takes a list
        if paths:
            scanned = feeds.csv_scan(session, paths, schema=schema, **csv)
            named = scanned.withColumn(FILE, plain_path(F.col(feeds.FILE_COLUMN)))
            feeds.without_extras(named).write.parquet(f"{folder}/rows")
            rows = session.read.schema(feeds.without_extras(named).schema).parquet(f"{folder}/rows")
            if not table.exists():
                table.ensure_database()
                table.create(rows.schema)
            table.replace_by(files.select(F.col("file_path").alias(FILE)), rows, FILE)
        delete_path(session, folder)

    return (
        changes(spark, listings).writeStream.foreachBatch(replace).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
