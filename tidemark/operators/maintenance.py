"""Plans for table maintenance, as queries over file listings."""

from __future__ import annotations

from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.names import as_utc

MEGABYTE = 1024 * 1024


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def files_of(df: DataFrame, depth: int = 0) -> DataFrame:
    """``(partition, file_path, file_size, modified_at)`` of the files a parquet
    relation reads, by listing their folders: no file is opened. The folders come from
    the listing that Spark's driver holds to plan a scan. ``depth`` is the number of
    partition columns: of one, ``partition`` is its value, of several ``a=1/b=2`` as
    folders spell it."""
    folders = sorted({unquote(path).rpartition("/")[0] for path in df.inputFiles()})
    if not folders:
        return df.sparkSession.createDataFrame([], "partition string, file_path string, file_size long, modified_at timestamp")
    listed = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folders)
    path = F.col("_metadata.file_path")
    text = F.regexp_extract("path", "((?:/[^/=]+=[^/]*){%d})/[^/]*$" % depth, 1)
    if depth > 1:
        value = F.substring(text, F.lit(2), F.length(text))
    elif depth:
        text = F.regexp_replace(text, "^/[^/=]+=", "")
        value = F.when(text != NULL_PARTITION, F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))))
    else:
        value = F.lit(None).cast("string")
    return listed.select(
        value.alias("partition"), path.alias("file_path"), F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"))


def compaction_plan(files: DataFrame, target_mb: float = 128) -> DataFrame:
    """Per partition: files and bytes now, files after rewriting to the target
    size, and whether that is an improvement."""
    target = F.lit(target_mb * MEGABYTE)
    return (
        files.groupBy("partition")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))
        .withColumn("target_files", F.greatest(F.ceil(F.col("bytes") / target), F.lit(1)).cast("bigint"))
        .withColumn("rewrite", F.col("files") > F.col("target_files"))
    )


def orphan_files(listing: DataFrame, referenced: DataFrame, older_than: datetime | Column) -> DataFrame:
    """Listed files nobody references that are older than the cutoff; younger
    ones may belong to a write in progress."""
    cutoff = older_than if isinstance(older_than, Column) else F.lit(as_utc(older_than))
    return listing.where(F.col("modified_at") < cutoff).join(
        referenced.select("file_path").distinct(), "file_path", "left_anti"
    )
