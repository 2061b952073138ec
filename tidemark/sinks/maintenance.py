"""Maintenance of parquet tables: compaction, orphan files, old versions."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from itertools import islice

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import col, plain_path, require_columns
from tidemark.functions.names import as_utc, unique, utc_now
from tidemark.functions.partitioning import Partitioning
from tidemark.operators.maintenance import MEGABYTE, NULL_PARTITION, compaction_plan, files_of, orphan_files
from tidemark.sinks.places import delete_path
from tidemark.sinks.tables import ParquetTable, Staged, spec_values

# Partitions rewritten and published together, deletes at a time, and files deleted together.
_BLOCK, _DELETES_AT_ONCE, _DELETES = 1000, 8, 10_000


def table_files(table: ParquetTable) -> DataFrame:
    rule = table.partition
    return files_of(table.spark.table(table.name), len(rule.names) if rule else 0)


def compact(table: ParquetTable, target_mb: float = 128) -> int:
    """Rewrite the partitions that hold more files than they need; returns how
    many files were replaced. Rows are unchanged, and readers keep the old files
    until they are removed as orphans."""
    plan = compaction_plan(table_files(table), target_mb).where("rewrite")
    todo = plan.select("partition", "files", "target_files").collect()  # one row per partition
    if not todo:
        return 0
    if table.partition is None:
        table.publish_replace(_rewrite_whole(table, target_mb))
    for start in range(0, len(todo) if table.partition else 0, _BLOCK):
        table.publish_partitions(_rewrite_partitions(table, todo[start:start + _BLOCK], target_mb))
    return sum(r["files"] for r in todo)


def _rewrite_whole(table: ParquetTable, target_mb: float) -> Staged:
    """Map-only: a scan task takes as many small files as fit the target size and
    writes one file. The settings live in a session of their own."""
    session = table.spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(int(target_mb * MEGABYTE)))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    path = f"{table.versions}/{unique('v')}"
    df = session.table(table.name)
    df.write.option("compression", "zstd").parquet(path)
    return Staged(path, df.schema)


def _rewrite_partitions(table: ParquetTable, todo: list, target_mb: float) -> Staged:
    """One job: neighbouring files of a partition, in order of name, become one file of
    about the target size, rows in the order they had.

    A file's place in the running sum of its partition's sizes says which new file it
    goes to, and each new file is one task. Only rows of partitions that are rewritten are
    read and move; the folder of such a partition is new, so all its files are written."""
    spark, rule = table.spark, table.partition
    whole = spark.table(table.name)
    first, bins = [], 0
    for r in todo:  # at most _BLOCK rows
        first.append((r["partition"], bins))
        bins += r["target_files"]
    wanted = F.broadcast(spark.createDataFrame(first, "wanted string, first long"))
    before = Window.partitionBy("partition").orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("file_size").over(before), F.lit(0))
    files = table_files(table).join(wanted, F.col("partition").eqNullSafe(F.col("wanted"))).select(
        F.col("file_path").alias("__path"), (F.col("first") + F.floor(start / F.lit(target_mb * MEGABYTE))).cast("int").alias("__bin"))
    rows = whole.where(_in_partitions(whole, rule, [r["partition"] for r in todo])).select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    placed = rows.join(files, F.col("__file") == F.col("__path")).repartitionById(bins, F.col("__bin"))
    ordered = placed.sortWithinPartitions(*[col(n) for n in rule.names], "__file", "__row")
    path = f"{table.versions}/{unique('v')}"
    ordered.select(*[col(c) for c in whole.columns]).write.option("compression", "zstd").partitionBy(*rule.names).parquet(path)
    return Staged(path, whole.schema, rule)


def _in_partitions(whole: DataFrame, rule: Partitioning, partitions: list[str | None]) -> Column:
    """Rows of the partitions, as ``files_of`` names them; the catalog prunes by it."""
    texts = [F.coalesce(col(c).cast("string"), F.lit(NULL_PARTITION)) for c in require_columns(whole.columns, rule.names)]
    if len(texts) == 1:
        return texts[0].isin([NULL_PARTITION if p is None else p for p in partitions])
    return F.array(*texts).isin([F.array(*map(F.lit, spec_values(p))) for p in partitions])


def version_files(table: ParquetTable) -> DataFrame:
    """``(file_path, file_size, modified_at)`` of every file below the table's
    version folders."""
    return (
        table.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(table.versions)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        )
    )


def find_orphans(table: ParquetTable, older_than_days: float = 3, now: datetime | None = None) -> DataFrame:
    """Files in the version folders the table does not read, older than the
    retention. The folder of an unpartitioned table is left alone: what it holds is
    the table, be it files without rows."""
    cutoff = (now or utc_now()) - timedelta(days=older_than_days)
    listed = version_files(table)
    if table.partition is None:
        listed = listed.where(~plain_path(F.col("file_path")).startswith(table.location + "/"))
    return orphan_files(listed, table_files(table), cutoff)


def remove_orphans(table: ParquetTable, older_than_days: float = 3, now: datetime | None = None) -> int:
    """Delete what ``find_orphans`` finds; returns the number of files. The list
    is streamed, not collected."""
    return _delete(table, find_orphans(table, older_than_days, now).select("file_path"))


def _delete(table: ParquetTable, paths: DataFrame) -> int:
    """Delete paths a block at a time, several deletes at once."""
    rows, removed = paths.toLocalIterator(prefetchPartitions=True), 0
    with ThreadPoolExecutor(_DELETES_AT_ONCE) as pool:
        while block := [_decoded(r[0]) for r in islice(rows, _DELETES)]:
            removed += sum(map(bool, pool.map(lambda path: delete_path(table.spark, path), block)))
    return removed


def versions(table: ParquetTable) -> DataFrame:
    """One row per version folder: files, bytes, newest file, and how many of the
    files the table still reads."""
    used = table_files(table).select("file_path", F.lit(1).alias("__used"))
    marker = f"{table.table}__versions"
    return (
        version_files(table).join(used, "file_path", "left")
        .groupBy(F.regexp_extract("file_path", f"^(.*/{marker}/[^/]+)/", 1).alias("version"))
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("file_size").alias("bytes"),
            F.max("modified_at").alias("modified_at"),
            F.count("__used").alias("used_files"),
        )
    )


def expire_versions(table: ParquetTable, older_than_days: float = 3, now: datetime | None = None) -> int:
    """Delete whole version folders the table no longer reads and that are older
    than the retention (the parquet form of expiring snapshots)."""
    cutoff = F.lit(as_utc((now or utc_now()) - timedelta(days=older_than_days)))
    current = table.location  # kept even if it holds no rows
    old = versions(table).where(
        (F.col("used_files") == 0) & (F.col("modified_at") < cutoff) & ~F.lit(f"{current}/").startswith(F.concat(plain_path(F.col("version")), F.lit("/")))
    )
    return _delete(table, old.select("version"))


def _decoded(path: str) -> str:
    from urllib.parse import unquote

    return unquote(path)
