"""Column transforms in their fixed order: exclude, rename, cast, derive, audit."""

from __future__ import annotations

import getpass
import logging
import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.errors import ParseException

from tidemark.functions.columns import col, find_column, renamed, require_columns
from tidemark.functions.zone import require_utc

log = logging.getLogger(__name__)


def project(df: DataFrame, columns: Iterable[str] | None) -> DataFrame:
    """Include-list. Without a list everything is kept; an unknown name raises."""
    names = list(columns or [])
    return df.select([col(c) for c in require_columns(df.columns, names)]) if names else df


def exclude(df: DataFrame, *name_lists: Iterable[str] | None) -> DataFrame:
    """Drop the union of the lists; names match any case, unknown ones are ignored."""
    wanted = {name.strip().casefold() for names in name_lists for name in (names or [])}
    return df.drop(*[c for c in df.columns if c.casefold() in wanted])


def rename(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename by case-insensitive lookup; a missing column is skipped."""
    found = {}
    for old, new in renames.items():
        actual = find_column(df.columns, old)
        if actual is None:
            log.warning("rename: no column %r, skipped", old)
        else:
            found[actual] = new
    return df.withColumnsRenamed(found) if found else df


def cast(df: DataFrame, casts: Mapping[str, str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Lenient casts: text that does not parse becomes NULL. Keys may use the
    name before or after the rename; a missing column or unknown type is skipped."""
    changed = {}
    for name, type_name in casts.items():
        actual = find_column(df.columns, renamed(name, renames or {}))
        if actual is None:
            log.warning("cast: no column %r, skipped", name)
            continue
        try:
            T.DataType.fromDDL(type_name)
        except ParseException:
            log.warning("cast: unknown type %r for %r, skipped", type_name, name)
            continue
        changed[actual] = col(actual).try_cast(type_name)
    return df.withColumns(changed) if changed else df


def derive(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Add Spark SQL expressions in order; later ones see earlier ones, and a
    same-named column is replaced. An invalid expression raises."""
    for name, expression in expressions.items():
        df = df.withColumn(name, F.expr(expression))
    return df


@dataclass(frozen=True)
class AuditColumns:
    enabled: bool = True
    insert_ts: str = "dwh_insert_ts"
    updated_ts: str = "dwh_updated_ts"
    run_id: str = "dwh_etl_run_id"
    job_user: str = "dwh_job_user"
    timezone: str = "Asia/Dhaka"


def current_user() -> str:
    user = os.environ.get("USER") or os.environ.get("USERNAME")
    if user:
        return user
    try:
        return getpass.getuser()
    except (KeyError, OSError):
        return "etl_user"


def audit(
    df: DataFrame,
    columns: AuditColumns = AuditColumns(),
    run_id: str | None = None,
    job_id: str | None = None,
    job_user: str | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Stamp insert/update time (UTC shifted to the configured zone), run id and
    user. ``as_of`` (a UTC datetime) fixes the time; otherwise it is the query's
    start. The session time zone must be UTC, or the wall clock would be wrong: any
    other one is an error."""
    if not columns.enabled:
        return df
    require_utc(df.sparkSession)
    now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp") if as_of else F.current_timestamp()
    stamp = F.from_utc_timestamp(now, columns.timezone)
    return df.withColumns({
        columns.insert_ts: stamp,
        columns.updated_ts: stamp,
        columns.run_id: F.lit(run_id or job_id or "ETL_RUN_UNKNOWN"),
        columns.job_user: F.lit(job_user or current_user()),
    })


@dataclass(frozen=True)
class TransformRules:
    """What a spec says about columns."""

    exclude: tuple[str, ...] = ()
    rename: Mapping[str, str] = None
    cast: Mapping[str, str] = None
    derived: Mapping[str, str] = None


@dataclass(frozen=True)
class AggregateRules:
    """Keys to group by, and SQL aggregates by the name of their result column."""

    keys: tuple[str, ...] = ()
    columns: Mapping[str, str] = None


def aggregate(df: DataFrame, rules: AggregateRules) -> DataFrame:
    """One row per key with the aggregates; one row in all without keys. Spark combines
    rows before the shuffle, so a frequent key is one row per task."""
    if not rules.columns:
        return df
    keys = require_columns(df.columns, rules.keys)
    return df.groupBy(*[col(k) for k in keys]).agg(*[F.expr(sql).alias(name) for name, sql in rules.columns.items()])


def transform(
    df: DataFrame | None,
    rules: TransformRules,
    source_exclude: Iterable[str] | None = None,
    audit_columns: AuditColumns | None = None,
    aggregation: AggregateRules = AggregateRules(),
    **audit_values,
) -> DataFrame | None:
    """All steps as one lazy projection chain; no input gives no output."""
    if df is None:
        return None
    out = exclude(df, rules.exclude, source_exclude)
    out = rename(out, rules.rename or {})
    out = cast(out, rules.cast or {}, rules.rename or {})
    out = aggregate(derive(out, rules.derived or {}), aggregation)
    return audit(out, audit_columns, **audit_values) if audit_columns else out
