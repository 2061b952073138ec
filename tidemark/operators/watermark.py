"""High-watermark operators over batches and over the watermark ledger."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import col, require_columns
from tidemark.functions.partitioning import Partitioning
from tidemark.functions.types import INITIAL_WATERMARKS, watermark_literal
from tidemark.functions.zone import is_utc


@dataclass(frozen=True)
class Watermark:
    """The value a scan continues from. ``overlap`` reads again what lies that far
    before it (``'1 hour'``, or a number), for sources that deliver late or with
    equal values; only a keyed upsert can absorb the repeats."""

    column: str
    value: str | None
    kind: str = "timestamp"
    overlap: str | None = None
    ties: bool = False  # also rows that have the value itself

    def literal(self, data_type: T.DataType) -> Column:
        """Typed like the column, so the comparison reaches the scan."""
        literal = watermark_literal(self.value, data_type, self.kind)
        if not self.overlap:
            return literal
        if self.kind == "numeric":
            return (literal - F.lit(self.overlap).cast(data_type)).cast(data_type)
        return (literal - F.expr(f"INTERVAL {self.overlap}")).cast(data_type)

    def newer(self, df: DataFrame, partition: Partitioning | None = None) -> DataFrame:
        """Rows past the value, with ``ties`` also those at it; everything if there is none. For a table
        partitioned by a transform of the column the implied partition predicate is
        added, so older partitions are never opened."""
        if self.value in (None, ""):
            return df
        [name] = require_columns(df.columns, [self.column])
        literal = self.literal(df.schema[name].dataType)
        out = df.where(col(name) >= literal if self.ties else col(name) > literal)
        # Partition values are cut in UTC; in another zone the literal's would not fit them.
        for rule in partition.parts if partition and is_utc(df.sparkSession) else ():
            if rule.column.casefold() == name.casefold() and rule.name in df.columns:
                implied = rule.implied_by_after(literal)
                out = out if implied is None else out.where(implied)
        return out


#: Column of a batch that tells its source rows apart; not part of any target.
ROW_HASH = "__row_hash"


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits of a row's values, NULLs told from other values by their place."""
    parts = []
    for name in require_columns(df.columns, columns):
        value = col(name)
        if isinstance(df.schema[name].dataType, T.MapType):
            value = F.array_sort(F.map_entries(value))
        parts += [value.isNull(), value]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("one"), F.xxhash64(F.lit(2), *parts).alias("two"))


def without_seen(df: DataFrame, mark: Watermark, seen: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    """A scan with ``ties``, with ROW_HASH of ``columns``, less the rows at the watermark's
    value that an earlier batch had.

    ``seen`` has ``(row_hash, copies)``. Rows count as often as they come: of a row that
    was there twice and now comes three times, one is new. Only rows that have the value
    itself are grouped and joined; all others pass through. Without a value or ``seen``
    every row of the scan is new.
    """
    hashed = df.withColumn(ROW_HASH, row_hash(df, columns))
    if seen is None or mark.value in (None, ""):
        return hashed
    [name] = require_columns(df.columns, [mark.column])
    literal = mark.literal(df.schema[name].dataType)
    # Copies of a row are counted before the shuffle, so a row of many copies is one for each task.
    at = hashed.where(col(name) == literal).groupBy(ROW_HASH).agg(
        F.count(F.lit(1)).alias("there"), F.any_value(F.struct(*[col(c) for c in df.columns])).alias("row"))
    known = seen.groupBy("row_hash").agg(F.sum("copies").alias("copies")).withColumnRenamed("row_hash", "known")
    fresh = at.join(known, F.col(ROW_HASH) == F.col("known"), "left").withColumn("more", F.col("there") - F.coalesce("copies", F.lit(0)))
    again = fresh.where("more > 0").select("row", ROW_HASH, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("more"))).alias("copy"))
    return hashed.where(col(name) > literal).unionByName(again.select("row.*", ROW_HASH))


def boundary(batch: DataFrame, column: str, high: str | None) -> DataFrame:
    """``(row_hash, copies)`` of a batch's rows that have its highest watermark."""
    [name] = require_columns(batch.columns, [column])
    top = batch.where(col(name) == F.lit(high).cast(batch.schema[name].dataType))
    return top.groupBy(F.col(ROW_HASH).alias("row_hash")).agg(F.count(F.lit(1)).alias("copies"))


def newer_than(
    df: DataFrame, column: str, value: str | None, kind: str = "timestamp", partition: Partitioning | None = None
) -> DataFrame:
    return Watermark(column, value, kind).newer(df, partition)


def high_value(column: str | Column) -> Column:
    """Aggregate: the batch's high watermark as text, NULL for no rows."""
    return F.max(col(column) if isinstance(column, str) else column).cast("string")


def batch_high(df: DataFrame, column: str) -> DataFrame:
    [name] = require_columns(df.columns, [column])
    return df.agg(F.max(col(name)).alias("max_wm"))


def advance(previous: str | None, batch_max: str | None) -> str | None:
    """An empty batch leaves the watermark where it was."""
    return batch_max if batch_max not in (None, "") else previous


def start_value(stored: str | None, initial: str | None, kind: str = "timestamp") -> str | None:
    return stored or initial or INITIAL_WATERMARKS[kind]


def latest_per_job(ledger: DataFrame) -> DataFrame:
    """The newest ``watermark_value`` of every job. ``max_by`` combines before
    the shuffle, so a job with a long history is still one row per task."""
    return ledger.groupBy("job_id").agg(
        F.max_by("watermark_value", "updated_at").alias("watermark_value"),
        F.max("updated_at").alias("updated_at"),
    )
