"""Queries over the run ledger, the task list and the catalog of tables.

A run ledger has one row per run: ``run_id, job_id, start_time, end_time, status,
duration_seconds, rows_read, rows_written, error_message`` and more (see
``tidemark.sinks.ledgers``). Every per-job result comes from an aggregate that
combines before the shuffle: no operator gathers the runs of one job in a task.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import col, require_columns
from tidemark.functions.names import as_utc

SUCCESS, FAILED = "SUCCESS", "FAILED"


def on_day(ledger: DataFrame, day: date, ts: str = "start_time") -> DataFrame:
    """Runs of a day, as a range on the raw column so the scan can skip files."""
    kind = ledger.schema[ts].dataType
    return ledger.where(
        (col(ts) >= F.lit(day.isoformat()).cast(kind))
        & (col(ts) < F.lit((day + timedelta(days=1)).isoformat()).cast(kind))
    )


def failed_runs(ledger: DataFrame, day: date, ts: str = "start_time") -> DataFrame:
    """All failed runs of the day, one row each."""
    return on_day(ledger, day, ts).where(F.col("status") == FAILED)


def _per_job(runs: DataFrame, ts: str, counted_as: str) -> DataFrame:
    return runs.groupBy("job_id").agg(
        F.count(F.lit(1)).alias(counted_as), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )


def failed_jobs(ledger: DataFrame, day: date, ts: str = "start_time") -> DataFrame:
    """Jobs that failed on the day, one row per job; ``failed_runs`` has the runs."""
    return _per_job(failed_runs(ledger, day, ts), ts, "failures")


def succeeded_jobs(ledger: DataFrame, day: date, ts: str = "start_time") -> DataFrame:
    return _per_job(on_day(ledger, day, ts).where(F.col("status") == SUCCESS), ts, "successes")


def jobs_to_run(jobs: DataFrame, ledger: DataFrame, day: date, ts: str = "start_time") -> DataFrame:
    """Distinct candidate jobs that have not succeeded on the day."""
    done = on_day(ledger, day, ts).where(F.col("status") == SUCCESS).select("job_id").distinct()
    return jobs.select("job_id").distinct().join(done, "job_id", "left_anti")


def unrecovered_jobs(ledger: DataFrame, day: date, ts: str = "start_time") -> DataFrame:
    """Rerun set: jobs whose last failure of the day has no later success that
    day. Comparing two maxima replaces a self join of the ledger."""
    failed_at = F.max(F.when(F.col("status") == FAILED, F.col(ts)))
    succeeded_at = F.max(F.when(F.col("status") == SUCCESS, F.col(ts)))
    return (
        on_day(ledger, day, ts)
        .groupBy("job_id")
        .agg(failed_at.alias("failed_at"), succeeded_at.alias("succeeded_at"))
        .where(F.col("failed_at").isNotNull())
        .where(F.col("succeeded_at").isNull() | (F.col("succeeded_at") <= F.col("failed_at")))
        .select("job_id")
    )


def summary(ledger: DataFrame) -> DataFrame:
    """Batch outcome: total, succeeded, failed, distinct jobs."""
    return ledger.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == SUCCESS).alias("succeeded"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.count_distinct("job_id").alias("jobs"),
    )


def kpis(tasks: DataFrame, ledger: DataFrame, day: date, ts: str = "start_time") -> DataFrame:
    """One row: configured and enabled tasks, successes and failures of the day."""
    configured = tasks.agg(F.count(F.lit(1)).alias("configured"), F.count_if("enabled").alias("enabled"))
    runs = on_day(ledger, day, ts).agg(
        F.count_if(F.col("status") == SUCCESS).alias("successes"),
        F.count_if(F.col("status") == FAILED).alias("failures"),
    )
    zero = F.lit(0).cast("bigint")
    both = configured.select("configured", "enabled", zero.alias("successes"), zero.alias("failures")).unionByName(
        runs.select(zero.alias("configured"), zero.alias("enabled"), "successes", "failures")
    )
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def search(df: DataFrame, equals: Mapping[str, object] | None = None, text: str = "", within: Sequence[str] = ()) -> DataFrame:
    """Rows matching every equality AND, if text is given, holding it
    case-insensitively in at least one of the columns."""
    for name, wanted in (equals or {}).items():
        df = df.where(col(name) == F.lit(wanted))
    needle = text.strip().lower()
    if needle and within:
        hit = F.lit(False)
        for name in require_columns(df.columns, within):
            hit = hit | F.lower(col(name)).contains(needle)
        df = df.where(hit)
    return df


def facets(df: DataFrame, column: str, missing: str = "N/A") -> DataFrame:
    """Sorted distinct values, without NULL and the placeholder."""
    return df.where(col(column) != F.lit(missing)).select(col(column)).distinct().orderBy(col(column))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(tbl, n)`` per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def recent(df: DataFrame, newest_by: Sequence[str], rows: int = 50) -> DataFrame:
    """Top rows, newest first (TakeOrderedAndProject: no full sort)."""
    return df.orderBy(*[col(c).desc() for c in newest_by]).limit(rows)


# --- notification routing -------------------------------------------------

# Pipeline status -> event name.
STATUS_EVENTS = {
    "failed": "on_failure",
    "failure": "on_failure",
    "on_failure": "on_failure",
    "success": "on_success",
    "on_success": "on_success",
    "data_quality_failed": "on_quality_failure",
    "quality_failed": "on_quality_failure",
    "on_quality_failure": "on_quality_failure",
    "sla_breached": "on_sla_breach",
    "on_sla_breach": "on_sla_breach",
    "missing_file": "on_missing_file",
    "on_missing_file": "on_missing_file",
    "data_anomaly": "on_anomaly",
    "on_anomaly": "on_anomaly",
}


@dataclass(frozen=True)
class RoutingRule:
    event: str
    recipients: tuple[str, ...] = ()
    enabled: bool = True
    template: str = ""


def event_of(status: Column) -> Column:
    """The event a status stands for; an unknown status is its own event."""
    key = F.lower(F.trim(status))
    table = F.create_map(*[F.lit(x) for pair in STATUS_EVENTS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), key)


def route(
    runs: DataFrame, rules: Sequence[RoutingRule], default_recipients: Sequence[str] = (), status: str = "status"
) -> DataFrame:
    """Add ``event`` and ``rule``: the first enabled rule for the event, else
    ``default`` if the default has recipients, else NULL (nobody is told).

    The rules come from a spec, so they travel as a literal map: a status column
    has few values and a join on it would be all skew."""
    first = {}
    for rule in rules:
        event = rule.event.strip().lower()
        if rule.enabled and event not in first:
            first[event] = rule
    fallback = F.lit("default") if default_recipients else F.lit(None).cast("string")
    out = runs.withColumn("event", event_of(col(status)))
    if not first:
        return out.withColumn("rule", fallback)
    names = F.create_map(*[F.lit(x) for event in first for x in (event, event)])
    return out.withColumn("rule", F.coalesce(F.try_element_at(names, F.col("event")), fallback))


# --- task graph data ------------------------------------------------------

def task_edges(tasks: DataFrame) -> DataFrame:
    """``(task_id, depends_on)`` per dependency of ``depends_on array<string>``."""
    return tasks.select("task_id", F.explode("depends_on").alias("depends_on"))


def with_overrides(tasks: DataFrame, overrides: DataFrame) -> DataFrame:
    """Tasks whose ``depends_on`` a job's own task list replaces where it has one."""
    theirs = overrides.select("task_id", F.col("depends_on").alias("__theirs"))
    joined = tasks.join(theirs, "task_id", "left")
    return joined.withColumn("depends_on", F.coalesce("__theirs", "depends_on")).drop("__theirs")


def without_parent(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent: missing dependencies of a task graph,
    or broken references of a fact table. NULL keys have no parent."""
    return child.join(parent.select(col(parent_key).alias("__parent")), col(key) == F.col("__parent"), "left_anti")


def missing_dependencies(tasks: DataFrame) -> DataFrame:
    return without_parent(task_edges(tasks), "depends_on", tasks, "task_id")


# --- monitors -------------------------------------------------------------

def sla_breaches(ledger: DataFrame, limit_seconds: float | DataFrame, duration: str = "duration_seconds") -> DataFrame:
    """Runs that took longer than the limit: one for all, or ``(job_id, limit_seconds)``
    rows. A job without a limit breaches none."""
    if isinstance(limit_seconds, DataFrame):
        limits = limit_seconds.groupBy("job_id").agg(F.min("limit_seconds").alias("__limit"))
        return ledger.join(limits, "job_id").where(col(duration) > F.col("__limit")).select(*ledger.columns)
    return ledger.where(col(duration) > F.lit(limit_seconds))


# Kinds of a run's signals.
START, BEAT, END = "START", "BEAT", "END"


def run_intervals(signals: DataFrame, as_of: datetime | Column, at: str = "at") -> DataFrame:
    """``(job_id, run_id, start_time, end_time, last_seen, beats)`` of each run, from signals
    ``(job_id, run_id, signal, at)`` as they were known at ``as_of``.

    A run begins with its first START. It has ended with its last END, unless a START came
    after that: a resumed run is open again. ``last_seen`` is its last START or BEAT, or its
    END if that was earlier. A run without a START begins with what is known of it first.
    Minima and maxima say all that, so signals are combined before the one shuffle, by job and
    run, and neither a job of many runs nor a run of many beats is held in a task.
    """
    moment = as_of if isinstance(as_of, Column) else F.lit(as_utc(as_of))
    moment = moment.cast(signals.schema[at].dataType)
    known = signals.where(col(at) <= moment)
    is_ = lambda kind: F.col("signal") == kind
    runs = known.groupBy("job_id", "run_id").agg(
        F.min(F.when(is_(START), col(at))).alias("__start"), F.min(col(at)).alias("__first"), F.max(F.when(is_(START), col(at))).alias("__again"),
        F.max(F.when(is_(END), col(at))).alias("__last_end"), F.max(F.when(is_(BEAT), col(at))).alias("__beat"), F.count_if(is_(BEAT)).alias("beats"))
    ended = F.when(F.col("__last_end").isNotNull() & (F.col("__again").isNull() | (F.col("__last_end") >= F.col("__again"))), F.col("__last_end"))
    runs = runs.withColumns({"start_time": F.coalesce("__start", "__first"), "end_time": ended})
    seen = F.greatest("start_time", "__again", "__beat")
    return runs.select("job_id", "run_id", "start_time", "end_time", F.least(seen, F.coalesce("end_time", seen)).alias("last_seen"), "beats")


def open_runs(signals: DataFrame, as_of: datetime, limit_seconds: float | DataFrame | None = None, silent_seconds: float | None = None,
              at: str = "at") -> DataFrame:
    """``(job_id, run_id, start_time, last_seen, open_seconds, silent_seconds, reason)`` of runs
    that have started and not ended by ``as_of``, and are OVERDUE (open longer than the
    limit: one for all, or ``(job_id, limit_seconds)`` rows; no row is no limit), SILENT (no
    sign of life for ``silent_seconds``), or both."""
    moment = F.lit(as_utc(as_of))
    runs = run_intervals(signals, as_of, at).where(F.col("end_time").isNull())
    since = lambda name: (moment.cast("timestamp").cast("double") - F.col(name).cast("timestamp").cast("double"))
    runs = runs.withColumns({"open_seconds": since("start_time"), "silent_seconds": since("last_seen")})
    if isinstance(limit_seconds, DataFrame):
        limits = limit_seconds.groupBy(F.col("job_id").alias("__job")).agg(F.min("limit_seconds").alias("__limit"))
        runs = runs.join(limits, F.col("job_id").eqNullSafe(F.col("__job")), "left")
    else:
        runs = runs.withColumn("__limit", F.lit(limit_seconds).cast("double"))
    overdue = F.when(F.col("open_seconds") > F.col("__limit"), "OVERDUE")
    silent = F.when(F.col("silent_seconds") > F.lit(silent_seconds).cast("double"), "SILENT")
    reason = F.concat_ws(",", overdue, silent)
    return runs.withColumn("reason", reason).where("reason <> ''").select(
        "job_id", "run_id", "start_time", "last_seen", "open_seconds", "silent_seconds", "reason")


def config_name(path: Column) -> Column:
    """The file name of a spec's path: the same spec may be deployed to several folders."""
    return F.regexp_extract(path, "([^/\\\\]*)$", 1)


def daily_counts(runs: DataFrame, job: str, ts: str, rows: Column | None = None) -> DataFrame:
    """``(job, day, n)``: rows per job and day, or the sum of ``rows``."""
    n = F.count(F.lit(1)) if rows is None else F.sum(rows)
    return runs.groupBy(col(job), F.to_date(col(ts)).alias("day")).agg(n.alias("n"))


def calendar(daily: DataFrame, job: str) -> DataFrame:
    """``(job, day, n)`` with a row of 0 for every day without one, between a job's first
    day and the last day of all jobs: a job that stays away is the worst drop."""
    last = F.broadcast(daily.agg(F.max("day").alias("__last")))  # one row
    spans = daily.groupBy(col(job)).agg(F.min("day").alias("__first")).crossJoin(last)
    days = spans.select(col(job), F.explode(F.sequence("__first", "__last")).alias("day"))
    return days.join(daily, [job, "day"], "left").select(col(job), "day", F.coalesce("n", F.lit(0)).alias("n"))


def _before(job: str, window: int):
    return Window.partitionBy(col(job)).orderBy("day").rowsBetween(-window, -1)


def drops(daily: DataFrame, job: str, percent: int, window: int = 7) -> DataFrame:
    """Days on which a job's count is more than ``percent`` % below the mean of
    its previous ``window`` days of the calendar; a day without rows counts as 0. The
    input is already one row per job and day, so a window group is as long as the
    calendar, however many runs there were."""
    seen = _before(job, window)
    scored = calendar(daily, job).withColumns({"__s": F.sum("n").over(seen), "__c": F.count("n").over(seen)})
    low = F.col("n") * window * 100 < F.col("__s") * (100 - percent)
    return scored.where((F.col("__c") == window) & low).select(*daily.columns)


def outliers(daily: DataFrame, job: str, sigmas: float = 3.0, window: int = 7) -> DataFrame:
    """Days whose count is more than ``sigmas`` standard deviations away from the
    mean of the previous ``window`` days of the calendar."""
    seen = _before(job, window)
    scored = calendar(daily, job).withColumns({
        "__mean": F.avg("n").over(seen), "__dev": F.stddev_samp("n").over(seen), "__c": F.count("n").over(seen),
    })
    far = F.abs(F.col("n") - F.col("__mean")) > F.lit(sigmas) * F.col("__dev")
    return scored.where((F.col("__c") == window) & far).select(*daily.columns)


def missing_keys(expected: DataFrame, actual: DataFrame, expected_key: str, actual_key: str) -> DataFrame:
    """Expected rows nothing arrived for."""
    arrived = actual.select(col(actual_key).alias("__arrived")).distinct()
    return expected.join(arrived, col(expected_key) == F.col("__arrived"), "left_anti")


def missing_feeds(listing: DataFrame, expected: Iterable[tuple[str, str]], file_name: str = "file_name") -> DataFrame:
    """``(feed, pattern)`` of the expected feeds without a matching file: one
    pass over the listing, one counter per feed of the spec."""
    feeds = list(expected)
    counters = [
        F.count_if(col(file_name).rlike(fnmatch.translate(pattern))).alias(f"f{i}")
        for i, (_, pattern) in enumerate(feeds)
    ]
    rows = [
        F.struct(F.lit(feed).alias("feed"), F.lit(pattern).alias("pattern"), F.col(f"f{i}").alias("__files"))
        for i, (feed, pattern) in enumerate(feeds)
    ]
    return listing.agg(*counters).select(F.inline(F.array(*rows))).where("__files = 0").drop("__files")
