"""Run one load: extract, transform, stage, gate, publish, commit.

The source is read once. The transformed batch is staged as files while its row
count, NULL count and high watermark are observed; uniqueness is checked on the
staged key columns; only then is the batch published, and only after that are
watermark and file state committed. Whatever fails before the publish leaves
target and state as they were.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.columns import any_null, col, find_column, plain_path, renamed, require_columns
from tidemark.functions.names import utc_now
from tidemark.functions.zone import require_utc
from tidemark.operators import ledger as runs
from tidemark.operators.dedup import latest
from tidemark.operators.quality import QualityError, QualityResult, duplicate_count, enforce, judge, violations
from tidemark.operators.schema import additions, conform
from tidemark.operators.transform import project, transform
from tidemark.operators.watermark import Watermark, advance, boundary, high_value, start_value, without_seen
from tidemark.plans import hooks
from tidemark.plans.spec import LoadSpec, SpecError
from tidemark.sinks import ddl
from tidemark.sinks.ledgers import BoundaryStore, FileAudit, NotificationAudit, QualitySamples, RunLedger, RunSignals, WatermarkStore
from tidemark.sinks.native import NativeTable, has_plugin
from tidemark.sinks.places import delete_path, fresh_folder, path_exists
from tidemark.sinks.tables import MergeError, ParquetTable, Staged
from tidemark.sources import feeds, jdbc, tables

log = logging.getLogger(__name__)

#: Column by which good and bad rows of a feed are staged apart.
_VERDICT = "__verdict"


@dataclass(frozen=True)
class LoadResult:
    """``status``: SUCCESS, NO_DATA (a feed without files), SKIPPED (succeeded today) or
    DISABLED. ``rows_dropped`` are rows that a newer one with their key replaced."""

    status: str
    run_id: str = ""
    rows_read: int = 0
    rows_written: int = 0
    rows_dropped: int = 0
    watermark: str | None = None
    quality: QualityResult | None = None
    hooks: dict = field(default_factory=dict)


@dataclass
class _Batch:
    df: DataFrame | None
    listing: DataFrame | None = None  # the files of a feed
    pinned: str | None = None  # where the listing is stored
    hashed: tuple[str, ...] = ()  # source columns that tell rows of the watermark's value apart
    seen: DataFrame | None = None  # rows of that value which were loaded before


class LoadFailed(Exception):
    """A file of a feed could not be loaded."""


def open_target(spark: SparkSession, spec: LoadSpec):
    """The catalog's own tables where the catalog is a plugin; parquet in the session's
    catalog if the spec says so. Anything else is an error, never another format."""
    t = spec.target
    if has_plugin(spark, t.catalog):
        return NativeTable(spark, t.catalog, t.database, t.table, t.partition)
    if t.kind != "parquet":
        raise SpecError(f"[target] type {t.kind!r} needs a catalog plugin for {t.catalog!r}; none is configured")
    if t.catalog.lower() != "spark_catalog":
        raise SpecError(f"[target] catalog {t.catalog!r} is not configured; parquet tables are in spark_catalog")
    return ParquetTable(spark, t.database, t.table, t.partition)


def run_load(
    spark: SparkSession,
    spec: LoadSpec,
    batch: DataFrame | None = None,
    connection: jdbc.Connection | None = None,
    state_database: str = "etl_audit",
    run_id: str | None = None,
    job_user: str | None = None,
    as_of: datetime | None = None,
    config_path: str = "",
    force: bool = False,
    started: datetime | None = None,
) -> LoadResult:
    """Execute the spec. ``started`` is when the run was due, if it waited before this call. ``batch`` replaces the scan of the source (a DataFrame
    read elsewhere); the watermark filter still applies to it. ``as_of`` fixes the
    audit time. Failures are recorded in the run ledger and raised."""
    hooks.verify_names(spec)
    if not spec.task.enabled:
        return LoadResult("DISABLED")
    require_utc(spark)
    ledger = RunLedger(spark, state_database)
    if not force and succeeded_on(ledger, spec.task.id, utc_now().date(), config_path):
        return LoadResult("SKIPPED")

    run = {
        "run_id": run_id or str(uuid.uuid4()), "job_id": spec.task.id, "job_name": spec.task.name,
        "source_type": spec.source.type, "target_table": spec.target.full_name,
        "load_type": spec.load.type, "config_path": config_path, "start_time": started or utc_now(),
    }
    signal = _signals(spark, spec, run, state_database)
    signal(runs.START, "", run["start_time"])
    try:
        result = _execute(spark, spec, run, batch, connection, state_database, job_user, as_of, signal)
    except Exception as problem:
        signal(runs.END, "failed")
        ledger.record(run, problem)
        _notify(spark, spec, run, state_database, problem)
        raise
    signal(runs.END, "done")
    ended = utc_now()
    ledger.record(run | {"status": result.status, "end_time": ended, "rows_read": result.rows_read, "rows_written": result.rows_written})
    seconds = (ended - run["start_time"]).total_seconds()
    if result.status == "NO_DATA":
        _notify(spark, spec, run, state_database, "no file matches the feed", "MISSING_FILE")
    elif spec.task.sla_seconds and seconds > spec.task.sla_seconds:
        _notify(spark, spec, run, state_database, f"{seconds:.0f} s, the limit is {spec.task.sla_seconds} s", "SLA_BREACHED")
    return result


def dry_run(spark: SparkSession, spec: LoadSpec, batch: DataFrame | None = None,
            connection: jdbc.Connection | None = None, state_database: str = "etl_audit") -> T.StructType | None:
    """Validate the spec and plan scan and transforms without writing; the result
    is the schema that would be loaded."""
    hooks.verify_names(spec)
    store = WatermarkStore(spark, state_database)
    stored = store.get(spec.task.id) if spark.catalog.tableExists(store.ledger.name) else None
    found = _extract(spark, spec, batch, connection, None, _start(spec, stored))
    out = _transformed(spec, found.df, "dry_run", None, None)
    return None if out is None else feeds.without_extras(out).schema


def succeeded_on(ledger: RunLedger, job_id: str, day, config_path: str = "") -> bool:
    """Whether the job succeeded that day: of the same spec, if runs say which theirs was.
    A run without data is no success, so files that come later are still loaded."""
    todays = runs.on_day(ledger.since(day), day, "end_time")
    same = F.col("job_id") == job_id
    if config_path:
        other = F.coalesce(F.col("config_path"), F.lit(""))
        same = same & ((other == "") | (runs.config_name(other) == runs.config_name(F.lit(config_path))))
    return bool(todays.where(same & (F.col("status") == runs.SUCCESS)).head(1))


def _file_audit(spark, spec: LoadSpec, state_database: str) -> FileAudit:
    database, _, table = spec.source.feed.audit_table.rpartition(".")
    database = database.rpartition(".")[2]
    return FileAudit(spark, database or state_database, *([table] if table else []))


# --- steps ----------------------------------------------------------------

def _start(spec: LoadSpec, stored: str | None) -> str | None:
    if not spec.load.is_incremental:
        return None
    return start_value(stored, spec.load.initial_watermark, spec.load.watermark_type)


def _extract(spark, spec: LoadSpec, batch, connection, state_database, since: str | None) -> _Batch:
    """The scan of the source. Without a state database it is only planned: all
    files of a feed count as new."""
    source, load = spec.source, spec.load
    mark = None
    if load.is_incremental:
        mark = Watermark(load.watermark_column, since, load.watermark_type, load.overlap)
    known = None
    ties = load.keeps_ties and not spec.aggregate.columns and bool(state_database)
    if ties:
        known = BoundaryStore(spark, state_database).get(spec.task.id, since)
        mark = replace(mark, ties=known is not None)
    if not source.is_feed or batch is not None:
        if batch is not None:
            df = project(mark.newer(batch) if mark else batch, source.columns)
        elif source.type == "table":
            rule = ParquetTable(spark, source.schema, source.table).partition
            df = tables.scan(spark, source.full_name, source.columns, mark, rule)
        else:
            connection = connection or jdbc.connection_from_env(source.connection, source.type, source.schema)
            df = jdbc.scan(spark, connection, jdbc.table_name(source.schema, source.table), source.jdbc, source.columns, mark)
        if not ties:
            return _Batch(df)
        seen, hashed = known or (None, df.columns)
        return _Batch(without_seen(df, mark, seen, hashed), hashed=tuple(hashed), seen=seen)

    feed, pinned = source.feed, None
    listing = fresh = feeds.list_files(spark, feed.path, feed.pattern, feed.recursive)
    if state_database:
        # Stored at once: what is audited later must be the files read now, not
        # what the folder holds by then.
        pinned = fresh_folder(spark, "files")
        if load.is_incremental:  # a full load replaces rows, so it reads every file there is
            listing = feeds.new_files(listing, _file_audit(spark, spec, state_database).loaded(spec.target.full_name))
        listing.write.parquet(pinned)
        fresh = spark.read.schema(feeds.LISTING).parquet(pinned)
    paths = sorted(r["file_path"] for r in fresh.select("file_path").collect())  # the reader takes a list
    if not paths:
        if pinned:
            delete_path(spark, pinned)
        return _Batch(None)
    df = feeds.csv_scan(spark, paths, feed.header, feed.delimiter, feed.encoding, feed.schema, feed.bad_rows == "quarantine")
    return _Batch(df, fresh, pinned)


def _validate_source(spark, spec: LoadSpec, batch, connection) -> bool:
    """Settings are complete and the source is there; nothing is read."""
    source = spec.source
    if batch is not None or connection is not None:
        return True
    if source.is_feed:
        return path_exists(spark, source.feed.path)
    if source.type == "table":
        return spark.catalog.tableExists(source.full_name)
    return bool(jdbc.connection_from_env(source.connection, source.type, source.schema))


def _transformed(spec: LoadSpec, df, run_id, job_user, as_of):
    return transform(
        df, spec.transform, spec.source.exclude, spec.audit, spec.aggregate,
        run_id=run_id, job_id=spec.task.id, job_user=job_user, as_of=as_of,
    )


def _signals(spark, spec: LoadSpec, run: dict, state_database: str):
    """Records signs of life, if the spec asks for them."""
    if not spec.task.signals:
        return lambda *_: None
    book = RunSignals(spark, state_database)
    return lambda kind, step, at=None: book.record(run["job_id"], run["run_id"], kind, step, at)


def _execute(spark, spec: LoadSpec, run, batch, connection, state_database, job_user, as_of, signal) -> LoadResult:
    store = WatermarkStore(spark, state_database)
    table = open_target(spark, spec)
    since = _start(spec, store.get(spec.task.id) if spec.load.is_incremental else None)
    outcome = hooks.preload(spec, table, store, lambda: _validate_source(spark, spec, batch, connection))

    found = _extract(spark, spec, batch, connection, state_database, since)
    try:
        return _load_batch(spark, spec, run, found, table, store, since, outcome, state_database, job_user, as_of, signal)
    finally:
        if found.pinned:
            delete_path(spark, found.pinned)


def _load_batch(spark, spec: LoadSpec, run, found: _Batch, table, store, since, outcome, state_database, job_user, as_of, signal) -> LoadResult:
    if found.df is None:  # no file: the gate sees a batch of no rows
        verdict = enforce(judge(replace(spec.quality, null_check=(), unique_check=()), 0, 0, 0))
        return LoadResult("NO_DATA", run["run_id"], watermark=since, quality=verdict, hooks=outcome)
    df = _transformed(spec, found.df, run["run_id"], job_user, as_of)

    # What the batch looks like to the target; nothing is changed yet.
    table.ensure_database()
    exists = table.exists()
    visible = feeds.without_extras(df).schema
    keys = [renamed(k, spec.transform.rename) for k in spec.load.merge_keys]
    if exists:
        new = additions(visible, table.schema(), spec.evolution.evolution, spec.evolution.add_columns)
        extras = [f for f in df.schema.fields if f.name not in visible.names]
        df = conform(df, T.StructType([*table.schema().fields, *new, *extras]))
        visible = feeds.without_extras(df).schema
    keys = require_columns(visible.names, keys)
    rules = spec.quality
    if keys and rules.check_duplicate_keys is None and spec.load.watermark_column:
        rules = replace(rules, check_duplicate_keys=False)  # the newest row of a key is taken instead
    if not keys:  # the primary key is checked only where the spec asks for it
        rules = replace(rules, check_null_keys=bool(rules.check_null_keys), check_duplicate_keys=bool(rules.check_duplicate_keys))
    checked = keys or [renamed(k, spec.transform.rename) for k in spec.primary_key]
    rules = rules.effective(visible.names, checked, spec.transform.rename)

    apart = found.listing is not None and spec.source.feed.bad_rows == "quarantine"
    fits = F.col(feeds.CORRUPT_COLUMN).isNull() if apart else F.lit(True)
    high = None
    metrics = [F.count_if(fits).alias("rows"), F.count_if(fits & any_null(rules.null_check)).alias("nulls"),
               F.count_if(~fits).alias("misfits")]
    if spec.load.is_incremental:
        clock = find_column(visible.names, renamed(spec.load.watermark_column, spec.transform.rename))
        if clock is None:
            raise SpecError(f"watermark column {spec.load.watermark_column!r} is not in the batch")
        metrics.append(high_value(F.when(fits, col(clock))).alias("high"))

    rejected = None
    staged = _stage(spark, table, df.withColumn(_VERDICT, F.when(fits, "good").otherwise("bad")) if apart else df, metrics, _VERDICT if apart else None)
    written, listing = staged, found.listing
    try:
        counts = feeds.file_counts(staged.read(spark)) if listing is not None and not apart else None
        if apart:
            staged, rejected, counts, listing = _set_apart(spark, spec, table, written, metrics, listing, _file_audit(spark, spec, state_database))
        total, high = staged.metrics["rows"], staged.metrics.get("high")
        if not apart:
            _refuse_bad_rows(spec, counts, listing, _file_audit(spark, spec, state_database))
        duplicates = 0
        if rules.enabled and rules.unique_check and total:
            duplicates = duplicate_count(staged.rows(spark), rules.unique_check).first()[0]
        verdict = judge(rules, total, staged.metrics["nulls"], duplicates)
        if not verdict.passed and (shown := violations(feeds.without_extras(staged.rows(spark)), rules, verdict)) is not None:
            QualitySamples(spark, state_database).record(run["job_id"], run["run_id"], shown)
        enforce(verdict)
        ambiguous = bool(keys and total) and not (rules.enabled and set(rules.unique_check) == set(keys)) and bool(
            duplicate_count(staged.rows(spark).where(~any_null(keys)), keys).first()[0])
        if counts is not None:  # kept apart, as publishing may drop the staged files
            counted = fresh_folder(spark, "counts")
            counts.select("file_path", "record_count").write.parquet(counted)
            counts = spark.read.schema("file_path string, record_count bigint").parquet(counted)
        if high and found.hashed:
            tied, tied_path = boundary(staged.read(spark), clock, high), fresh_folder(spark, "ties")
            tied.write.parquet(tied_path)
            tied = spark.read.schema(tied.schema).parquet(tied_path)
    except Exception:
        delete_path(spark, written.path)
        if staged is not written:
            delete_path(spark, staged.path)
        raise

    signal(runs.BEAT, "staged")
    dropped = 0
    if ambiguous and spec.load.watermark_column:  # the newest row of a key is taken
        rows = staged.rows(spark)
        dropped = total - rows.where(~any_null(keys)).select(*keys).distinct().count() - rows.where(any_null(keys)).count()
    if isinstance(table, NativeTable):
        _publish_native(spark, spec, table, staged, exists, keys, ambiguous)
    else:
        _publish(spark, spec, table, staged, exists, visible, keys, ambiguous)
    if rejected is not None and written.metrics["misfits"]:
        _record_rejected(spark, spec, table, rejected.read(spark), run["run_id"])
        delete_path(spark, rejected.path)

    mark = since
    if spec.load.is_incremental:
        mark = advance(since, high)
        if high and found.hashed:
            kept = BoundaryStore(spark, state_database)
            same = found.seen if high == since else None  # more rows of the value that was there
            kept.put(spec.task.id, high, tied.unionByName(same) if same is not None else tied, found.hashed)
            delete_path(spark, tied_path)
        if high:
            store.put(spec.task.id, high)
            if found.hashed:
                kept.forget_before(spec.task.id, high)
    if listing is not None:
        _file_audit(spark, spec, state_database).record(listing, _plain_paths(counts), spec.target.full_name)
        delete_path(spark, counted)
    signal(runs.BEAT, "published")
    outcome |= hooks.postload(spec, table, mark)
    return LoadResult("SUCCESS", run["run_id"], total, total - dropped, dropped, mark, verdict, outcome)


def _stage(spark, table, df, metrics, tag: str | None = None) -> Staged:
    if isinstance(table, ParquetTable):
        return table.stage(df, metrics, tag=tag)
    from pyspark.sql import Observation

    seen, path = Observation(), fresh_folder(spark, "stage")
    writer = df.observe(seen, *metrics).write.option("compression", "zstd")
    (writer.partitionBy(tag) if tag else writer).parquet(path)
    return Staged(path, T.StructType([f for f in df.schema.fields if f.name != tag]), None, seen.get)


def _set_apart(spark, spec: LoadSpec, table, written: Staged, metrics, listing, audit: FileAudit):
    """The rows that fit, the others, counts of the former by file, and the files they are from.

    Both were staged by one write. Files with too many misfits are refused: audited as FAILED,
    and their good rows left out, for which alone rows are written again. A full load replaces
    all rows, so there a refused file refuses the load."""
    feed = spec.source.feed
    good, bad = (written.tagged(spark, _VERDICT, v) for v in ("good", "bad"))
    both = good.read(spark).unionByName(bad.read(spark))
    counts, path = feeds.file_counts(both), fresh_folder(spark, "counts")
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    over = F.col("corrupt_count") > feed.bad_share * F.col("record_count")
    if feed.bad_limit > 0:
        over = over | (F.col("corrupt_count") > feed.bad_limit)
    refused = counts.where(over)
    if refused.head(1):
        plain = _plain_paths(refused)
        audit.record(listing.join(plain, "file_path", "left_semi").select(*listing.columns),
                     plain.select("file_path", F.lit(0).cast("bigint").alias("record_count")), spec.target.full_name, runs.FAILED,
                     f"more than {feed.bad_share:.0%}{f' or {feed.bad_limit}' if feed.bad_limit > 0 else ''} of its rows do not fit its columns")
        listing = listing.join(plain, "file_path", "left_anti").select(*listing.columns)
        if spec.load.type == "full" or not listing.head(1):
            named = [r["file_path"] for r in plain.orderBy("file_path").limit(5).collect()]
            raise LoadFailed(f"too many rows that do not fit the file's columns: {plain.count()} file(s), among them {named}; the file audit has all")
        kept = good.read(spark).join(refused.select(F.col("file_path").alias(feeds.FILE_COLUMN)), feeds.FILE_COLUMN, "left_anti")
        kept = kept.select(*good.schema.names)
        good = _stage(spark, table, written.rule.drop_from(kept) if written.rule else kept, metrics)
    accepted = counts.where(~over).select("file_path", (F.col("record_count") - F.col("corrupt_count")).alias("record_count"))
    return good, bad, accepted, listing


def _record_rejected(spark, spec: LoadSpec, table, rows: DataFrame, run_id: str) -> None:
    """Append rows that did not fit: file, raw text and reason."""
    name = spec.source.feed.rejected_table or f"{spec.target.table}_rejected"
    out = rows.select(
        plain_path(F.col(feeds.FILE_COLUMN)).alias("file_path"), F.col(feeds.CORRUPT_COLUMN).alias("raw_text"),
        F.col(feeds.REASON_COLUMN).alias("reason"), F.lit(run_id).alias("run_id"), F.current_timestamp().alias("rejected_at"))
    if isinstance(table, NativeTable):
        store = NativeTable(spark, table.catalog, table.database, name)
        store.append(out) if store.exists() else store.create(out)
        return
    store = ParquetTable(spark, table.database, name)
    if not store.exists():
        store.create(T.StructType.fromDDL(ddl.REJECTED))
    store.publish_append(store.stage(out))


def _publish(spark, spec, table: ParquetTable, staged: Staged, exists, visible, keys, ambiguous) -> None:
    clock = spec.load.watermark_column
    if ambiguous and clock:  # several rows of a key: the newest one counts
        rows = feeds.without_extras(staged.rows(spark))
        newest = table.stage(latest(rows, keys, [renamed(clock, spec.transform.rename)]))
        table.discard(staged)
        newest.metrics = staged.metrics
        staged, ambiguous = newest, False
    if ambiguous:
        raise MergeError(f"several rows of the batch share a key {keys}")
    if not exists:
        table.publish_new(staged, feeds.EXTRAS)
        return
    table.reconcile(visible, spec.evolution.evolution, spec.evolution.add_columns)
    if not staged.metrics["rows"] and (keys or spec.load.is_incremental):
        table.discard(staged)  # nothing to add
        return
    if keys:
        table.merge(feeds.without_extras(staged.rows(spark)), keys, spec.load.preserve, keys_verified=True)
        table.discard(staged)
    elif spec.load.type != "full":
        table.publish_append(staged)
    elif spec.target.replaces_all(spec.load):
        table.publish_replace(staged)
    else:
        table.publish_partitions(staged)


def _publish_native(spark, spec, table: NativeTable, staged: Staged, exists, keys, ambiguous) -> None:
    source = feeds.without_extras(staged.rows(spark))
    if ambiguous and spec.load.watermark_column:
        source = latest(source, keys, [renamed(spec.load.watermark_column, spec.transform.rename)])
    if not exists:
        table.create(source)
    else:
        table.reconcile(source.schema, spec.evolution.evolution, spec.evolution.add_columns)
        if keys:
            table.merge(source, keys, spec.load.preserve)
        elif spec.load.type != "full":
            table.append(source)
        elif spec.target.replaces_all(spec.load):
            table.replace(source)
        else:
            table.overwrite_partitions(source)
    delete_path(spark, staged.path)


def _refuse_bad_rows(spec, counts, listing, audit: FileAudit) -> None:
    """A file with rows that do not fit fails the load and is audited as FAILED."""
    if counts is None or spec.source.feed.bad_rows != "fail":
        return
    bad = _plain_paths(counts.where("corrupt_count > 0").select("file_path", "corrupt_count"))
    if not bad.head(1):
        return
    broken = listing.join(bad.select("file_path"), "file_path", "left_semi").select(*listing.columns)
    message = "rows that do not fit the file's columns"
    audit.record(broken, bad.select("file_path", F.lit(0).cast("bigint").alias("record_count")),
                 spec.target.full_name, runs.FAILED, message)
    named, number = [r["file_path"] for r in bad.orderBy("file_path").limit(5).collect()], bad.count()
    raise LoadFailed(f"{message}: {number} file(s), among them {named}; the file audit has all")


def _plain_paths(df: DataFrame) -> DataFrame:
    return df.withColumn("file_path", plain_path(F.col("file_path")))


def _notify(spark, spec: LoadSpec, run: dict, state_database: str, problem: BaseException | str, status: str | None = None) -> None:
    """Record who should hear about a failure or a monitor's event; the mail itself is
    sent elsewhere."""
    if not spec.notify.enabled:
        return
    status = status or ("DATA_QUALITY_FAILED" if isinstance(problem, QualityError) else runs.FAILED)
    one = tables.rows(spark, [(status,)], "status string")
    routed = runs.route(one, spec.notify.rules, spec.notify.recipients).first()
    rule = next((r for r in spec.notify.rules if r.enabled and r.event == routed["rule"]), None)
    recipients = rule.recipients if rule else spec.notify.recipients if routed["rule"] else ()
    NotificationAudit(spark, state_database).record({
        "job_id": run["job_id"], "job_name": run["job_name"], "run_id": run["run_id"],
        "event_type": routed["event"], "pipeline_status": status, "sender": spec.notify.sender,
        "recipients_to": ",".join(recipients), "recipients_cc": ",".join(spec.notify.copies) or None,
        "subject": spec.notify.subject or f"{routed['event']}: {run['job_name']}", "template_used": rule.template if rule else None,
        "email_status": "NOT_SENT" if recipients else "NO_RECIPIENTS", "error_message": str(problem),
    })
