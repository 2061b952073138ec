"""Keyed upsert as a pure operator, with the semantics of MERGE: matched rows are
updated, unmatched source rows inserted, everything else kept."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import any_null, col, require_columns

#: Of more rows a batch is joined by a shuffle. Below that Spark's own size check decides.
BROADCAST_ROWS = 100_000


def by_rows(source: DataFrame) -> DataFrame:
    """The batch, never to be broadcast if it has many rows. Spark judges a stored batch by its
    compressed files, and millions of alike rows fit a few megabytes there, but not the driver.
    Counting a stored batch reads no column."""
    return source.hint("merge") if source.count() > BROADCAST_ROWS else source


def on_keys(keys: Iterable[str], left: str, right: str) -> Column:
    """``left.k = right.k AND ...``; not null-safe, as MERGE conditions are."""
    names = list(keys)
    if not names:
        raise ValueError("a merge needs at least one key")
    condition = F.lit(True)
    for k in names:
        condition = condition & (F.col(f"{left}.`{k}`") == F.col(f"{right}.`{k}`"))
    return condition


def touched_values(target: DataFrame, source: DataFrame, keys: Iterable[str], partition: Sequence[Column], names: Sequence[str]) -> DataFrame:
    """Distinct partition values of the target, under new names, that hold a row with a source key."""
    columns = [col(k) for k in keys]
    located = target.select(*columns, *[value.alias(name) for value, name in zip(partition, names, strict=True)])
    return located.join(source.select(*columns), list(keys), "left_semi").select(*names).distinct()


def update_matched(
    target: DataFrame,
    source: DataFrame,
    keys: Iterable[str],
    preserve: Iterable[str] = (),
    newer_by: Sequence[str] = (),
) -> DataFrame:
    """Every target row, updated if its key is in the source.

    The target is read once, as the left side: a small source is broadcast and the
    target not shuffled at all, and in a shuffled join adaptive skew handling can split
    a hot target key, or many rows with NULL keys, which match nothing."""
    names = require_columns(target.columns, keys)
    if not names:
        raise ValueError("a merge needs at least one key")
    kept = set(require_columns(target.columns, preserve))
    incoming = source.select(F.lit(True).alias("__hit"), *[col(c).alias(f"__new_{c}") for c in source.columns])
    condition = F.lit(True)
    for k in names:
        condition = condition & (col(k) == col(f"__new_{k}"))
    joined = target.join(incoming, condition, "left")

    hit = F.col("__hit").isNotNull()
    take = hit
    if newer_by:
        clock = require_columns(target.columns, newer_by)
        take = hit & (F.struct(*[col(f"__new_{c}") for c in clock]) >= F.struct(*[col(c).alias(f"__new_{c}") for c in clock]))
    values = [
        col(c) if c in kept else F.when(take, col(f"__new_{c}")).otherwise(col(c)).alias(c) for c in target.columns
    ]
    return joined.select(*values)


def unmatched(source: DataFrame, present: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Source rows to insert: their key is not among ``present``, or is NULL. Of the
    present keys only the source's are kept and made distinct, so a hot one is one row."""
    names = require_columns(source.columns, keys)
    columns = [col(k) for k in names]
    known = present.select(*columns).join(source.select(*columns), names, "left_semi").distinct()
    rest = source.where(~any_null(names)).join(known, names, "left_anti")
    return rest.unionByName(source.where(any_null(names)))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Iterable[str],
    preserve: Iterable[str] = (),
    newer_by: Sequence[str] = (),
) -> DataFrame:
    """Target after ``MERGE ... UPDATE SET * ... INSERT *``.

    * Source keys must be unique; the caller checks or deduplicates.
    * Target rows that share a key are all updated, and NULL keys never match.
    * ``preserve`` keeps the target's value of those columns on a match.
    * ``newer_by`` updates only if the source is not older by those columns,
      compared in order with NULL as the oldest.
    """
    names = require_columns(target.columns, keys)
    source = source.select(*[col(c) for c in require_columns(source.columns, target.columns)]).toDF(*target.columns)
    updated = update_matched(target, source, names, preserve, newer_by)
    return updated.unionByName(unmatched(source, target, names))
