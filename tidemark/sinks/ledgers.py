"""Append-only ledgers: runs, watermarks, file audit, notifications.

Many loads write to one ledger at the same time, and two Spark jobs appending to
one folder remove each other's temporary files. So every commit writes a folder
of its own, which is then attached to the ledger table as a partition.
"""

from __future__ import annotations

import hashlib
import traceback
import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions.names import as_utc, identifier, sql_text, unique, utc_now
from tidemark.operators.ledger import FAILED, SUCCESS
from tidemark.operators.watermark import latest_per_job
from tidemark.sinks import ddl
from tidemark.sinks.places import delete_path, move_path, path_exists, paths_like, touch
from tidemark.sources.tables import row, rows as rows_of

#: Scopes that a roll-up merges in one job, and partitions in one statement.
_SCOPES_AT_ONCE = 200
#: How names of merged commits begin; those of others begin with c.
_MERGED = "r"
#: Column in which one row of a merged commit has the commits it replaces.
_REPLACES = "replaced_commits"
#: File that Spark leaves in a folder whose job has ended well.
_WHOLE = "_SUCCESS"


def _folder_value(spark: SparkSession, value) -> str:
    """A value as partition folders spell it."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


class Ledger:
    """A table partitioned by ``scope`` (a day, or a job) and commit."""

    def __init__(self, spark: SparkSession, database: str, table: str, columns: str, scope: str, scope_type: str):
        self.spark, self.database, self.table = spark, database, table
        self.name = identifier(database, table)
        self.scope, self.scope_type = scope, scope_type
        self.fields = T.StructType.fromDDL(columns)
        self._stored = T.StructType([f for f in self.fields if f.name != scope])

    def ensure(self) -> None:
        """Create database and table if missing; a new catalog over an existing
        folder finds the commits that are there."""
        if self.spark.catalog.tableExists(self.name):
            if _REPLACES not in self.spark.table(self.name).columns:  # made before commits could be merged safely
                self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({_REPLACES} ARRAY<STRING>)")
            return
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {identifier(self.database)}")
        full = T.StructType([*self._stored.fields]).add(_REPLACES, T.ArrayType(T.StringType())).add(self.scope, self.scope_type).add("commit_id", "string")
        self.spark.sql(ddl.create_table(self.name, full, self.root, [self.scope, "commit_id"]))
        self.recover()

    def recover(self) -> None:
        """Attach the whole commits below the ledger's folder: those with a mark of success. Of
        merged commits and what they replace both may be there; readers skip the latter."""
        found = {}
        for path in paths_like(self.spark, f"{self.root}/{self.scope}=*/commit_id=*/{_WHOLE}"):
            scope, commit = path.rsplit("/", 3)[1:3]
            found.setdefault(unquote(scope.partition("=")[2]), []).append(commit.partition("=")[2])
        self._attach(found)

    @property
    def root(self) -> str:
        return f"{self.spark.catalog.getDatabase(self.database).locationUri.rstrip('/')}/{self.table}"

    def _folder(self, scope, commit: str) -> str:
        return f"{self.root}/{self.scope}={_folder_value(self.spark, scope)}/commit_id={commit}"

    def _partition(self, scope, commit: str) -> str:
        return f"PARTITION (`{self.scope}` = {sql_text(scope)}, commit_id = {sql_text(commit)})"

    def _attach(self, commits: Mapping[object, Sequence[str]]) -> None:
        parts = [f"{self._partition(s, c)} LOCATION {sql_text(self._folder(s, c))}" for s, some in commits.items() for c in some]
        for at in range(0, len(parts), _SCOPES_AT_ONCE):
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {' '.join(parts[at:at + _SCOPES_AT_ONCE])}")

    def detach(self, commits: Mapping[object, Sequence[str]]) -> None:
        """Forget commits; their files stay, as a reader may still use them."""
        parts = [self._partition(s, c) for s, some in commits.items() for c in some]
        for at in range(0, len(parts), _SCOPES_AT_ONCE):
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {', '.join(parts[at:at + _SCOPES_AT_ONCE])}")
        if parts:
            self.spark.catalog.refreshTable(self.name)

    def append(self, df: DataFrame, scope) -> None:
        self.ensure()
        commit = unique("c")
        df.select(*self._stored.names).write.option("compression", "zstd").parquet(self._folder(scope, commit))
        self._attach({scope: [commit]})

    def append_row(self, values: Sequence, scope) -> None:
        """One row held by the driver, given in column order."""
        exact = [as_utc(v) if isinstance(v, datetime) else v for v in values]
        self.append(row(self.spark, exact, self._stored).coalesce(1), scope)

    def visible(self) -> DataFrame:
        """The table without the commits that a merged one replaces, whether or not they are
        still attached. Merged commits say in one row what they replace; of all other
        commits nothing but partition names is looked at for that."""
        self.ensure()
        rows = self.spark.table(self.name)
        merged = rows.where(F.col("commit_id").startswith(_MERGED) & F.col(_REPLACES).isNotNull())
        gone = merged.select(F.col(self.scope).alias("__scope"), F.explode(_REPLACES).alias("__commit")).distinct()
        return rows.join(gone, (F.col(self.scope) == F.col("__scope")) & (F.col("commit_id") == F.col("__commit")), "left_anti")

    def read(self) -> DataFrame:
        return self.visible().select(*self.fields.names)

    def commits(self) -> dict[str, list[str]]:
        """The attached commits by scope, as text. One name for each comes to the driver."""
        self.ensure()
        found: dict[str, list[str]] = {}
        for (spec,) in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect():
            scope, _, commit = spec.partition("/commit_id=")
            found.setdefault(unquote(scope.partition("=")[2]), []).append(commit)
        return found

    def roll_up(self, keep: Sequence = ()) -> int:
        """Merge the commits of a scope (a day, a job) into one, but for the scopes in
        ``keep``, such as a day that is not over; returns how many commits went.

        A merged commit names those it replaces, and readers skip these, so at no time a row
        is seen twice or missed. A run that stopped half-way is finished by the next one:
        what is replaced already is only detached. One roll-up of a ledger at a time."""
        kept, before = {str(k) for k in keep}, self.commits()
        some = {s: c for s, c in before.items() if len(c) > 1 and s not in kept}
        replaced = self._replaced(some)
        self.detach(replaced)  # left by a run that stopped
        todo = {s: left for s, c in some.items() if len(left := [x for x in c if x not in replaced.get(s, ())]) > 1}
        scopes = sorted(todo)
        for at in range(0, len(scopes), _SCOPES_AT_ONCE):
            self._merge_commits({s: todo[s] for s in scopes[at:at + _SCOPES_AT_ONCE]})
        return sum(map(len, before.values())) - sum(map(len, self.commits().values()))

    def _replaced(self, commits: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
        """The attached commits that an attached merged one replaces."""
        if not any(c.startswith(_MERGED) for some in commits.values() for c in some):
            return {}
        rows = self.spark.table(self.name).where(F.col("commit_id").startswith(_MERGED) & F.col(_REPLACES).isNotNull())
        named = rows.select(F.col(self.scope).cast("string").alias("scope"), F.explode(_REPLACES).alias("commit")).distinct().collect()
        found: dict[str, list[str]] = {}
        for scope, commit in named:
            if commit in commits.get(scope, ()):
                found.setdefault(scope, []).append(commit)
        return found

    def _merge_commits(self, commits: dict[str, list[str]]) -> None:
        """The name of a merged commit follows from what it replaces: a repeat writes the same one."""
        merged = {s: _MERGED + hashlib.sha1(",".join(sorted(c)).encode()).hexdigest() for s, c in commits.items()}
        names = rows_of(self.spark, [(s, merged[s], c) for s, c in commits.items()], "__scope string, __merged string, __replaces array<string>")
        rows = self.visible().where(F.col(self.scope).cast("string").isin(list(commits)) & F.col("commit_id").isin([c for v in commits.values() for c in v]))
        number = F.row_number().over(Window.partitionBy(self.scope).orderBy("commit_id"))
        rows = rows.join(F.broadcast(names), F.col(self.scope).cast("string") == F.col("__scope")).withColumns({
            _REPLACES: F.when(number == 1, F.col("__replaces")), "commit_id": F.col("__merged")})
        path = f"{self.root}/_{unique('rollup')}"
        rows.select(*self._stored.names, _REPLACES, self.scope, "commit_id").write.option("compression", "zstd").partitionBy(self.scope, "commit_id").parquet(path)
        for scope, commit in merged.items():
            self._place(f"{path}/{self._folder(scope, commit).removeprefix(self.root + '/')}", self._folder(scope, commit))
        delete_path(self.spark, path)
        self._attach({s: [c] for s, c in merged.items()})
        self.spark.catalog.refreshTable(self.name)
        self.detach(commits)

    def _place(self, written: str, folder: str) -> None:
        """Move a written commit to its folder and mark it as whole."""
        if path_exists(self.spark, f"{folder}/{_WHOLE}"):
            return  # by an earlier run that stopped
        delete_path(self.spark, folder)
        move_path(self.spark, written, folder)
        touch(self.spark, f"{folder}/{_WHOLE}")

    def since(self, day: date) -> DataFrame:
        """For day-scoped ledgers: commits of the day or later; older partitions
        are not opened. A run is committed when it ends, so all runs started on
        the day are among them."""
        recent = self.visible().where(F.col(self.scope) >= F.lit(day.isoformat()).cast("date"))
        return recent.select(*self.fields.names)


class WatermarkStore:
    """One watermark per job. Partitioned by job, so a lookup opens only that
    job's files and jobs do not get in each other's way."""

    def __init__(self, spark: SparkSession, database: str = "etl_audit", table: str = "watermark_store"):
        self.ledger = Ledger(spark, database, table, ddl.WATERMARKS, "job_id", "string")

    def get(self, job_id: str) -> str | None:
        return self.history(job_id).select(F.max_by("watermark_value", "updated_at")).first()[0]

    def put(self, job_id: str, value: str, at: datetime | None = None) -> None:
        """Raises on an empty value, and if the write fails."""
        if value is None or not str(value).strip():
            raise ValueError(f"empty watermark for job {job_id!r}")
        self.ledger.append_row((str(value), at or utc_now()), job_id)

    def history(self, job_id: str) -> DataFrame:
        return self.ledger.visible().where(F.col("job_id") == F.lit(job_id))

    def current(self) -> DataFrame:
        """Newest value of every job."""
        return latest_per_job(self.ledger.read())


class BoundaryStore:
    """The rows a job has loaded that have its watermark's value, so that rows of the same
    value that come later are told from them. One commit holds them all; a lookup opens
    the job's files only."""

    def __init__(self, spark: SparkSession, database: str = "etl_audit", table: str = "watermark_boundary"):
        self.ledger = Ledger(spark, database, table, ddl.BOUNDARIES, "job_id", "string")

    def _at(self, job_id: str, value: str) -> DataFrame:
        return self.ledger.visible().where((F.col("job_id") == F.lit(job_id)) & (F.col("watermark_value") == F.lit(value)))

    def get(self, job_id: str, value: str | None) -> tuple[DataFrame, list[str]] | None:
        """``(row_hash, copies)`` at the value, and the source columns that were hashed; None if there are none."""
        if value in (None, "") or not self.ledger.spark.catalog.tableExists(self.ledger.name):
            return None
        rows = self._at(job_id, value)
        last = rows.agg(F.max_by(F.struct("commit_id", "source_columns"), F.struct("updated_at", "commit_id")).alias("last")).first()["last"]
        if last is None:
            return None
        return rows.where(F.col("commit_id") == F.lit(last["commit_id"])).select("row_hash", "copies"), list(last["source_columns"])

    def put(self, job_id: str, value: str, rows: DataFrame, columns: Sequence[str], at: datetime | None = None) -> None:
        """Record ``(row_hash, copies)``: all rows at the value, not only new ones."""
        total = rows.groupBy("row_hash").agg(F.sum("copies").alias("copies"))
        stamp = F.lit((at or utc_now()).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
        self.ledger.append(total.select(
            F.lit(value).alias("watermark_value"), stamp.alias("updated_at"),
            F.array(*[F.lit(c) for c in columns]).alias("source_columns"), "row_hash", "copies"), job_id)

    def forget_before(self, job_id: str, value: str) -> None:
        """Detach what belongs to other values of the job's watermark."""
        if not self.ledger.spark.catalog.tableExists(self.ledger.name):
            return
        rows = self.ledger.spark.table(self.ledger.name).where(F.col("job_id") == F.lit(job_id))
        gone = [r[0] for r in rows.where(F.col("watermark_value") != F.lit(value)).select("commit_id").distinct().collect()]
        self.ledger.detach({job_id: gone})


class RunLedger(Ledger):
    """One row per run, successful or not."""

    def __init__(self, spark: SparkSession, database: str = "etl_audit", table: str = "etl_pipeline_telemetry"):
        super().__init__(spark, database, table, f"{ddl.RUNS}, {ddl.RUN_DETAILS}", "commit_day", "date")

    def record(self, run: dict, error: BaseException | None = None) -> None:
        """Append a run; with an error it is a failed one."""
        run = {"status": SUCCESS, "end_time": utc_now()} | run
        if error:
            run |= {
                "status": FAILED, "error_type": type(error).__name__, "error_message": str(error),
                "error_trace": "".join(traceback.format_exception(error)),
            }
        run["duration_seconds"] = (run["end_time"] - run["start_time"]).total_seconds()
        self.append_row([run.get(n) for n in self.fields.names], run["end_time"].date())


class RunSignals(Ledger):
    """Starts, heartbeats and ends of runs, each recorded when it happens: what is missing
    tells which runs have died (``tidemark.operators.ledger.open_runs``)."""

    def __init__(self, spark: SparkSession, database: str = "etl_audit", table: str = "etl_run_signals"):
        super().__init__(spark, database, table, ddl.SIGNALS, "commit_day", "date")

    def record(self, job_id: str, run_id: str, signal: str, step: str = "", at: datetime | None = None) -> None:
        at = at or utc_now()
        self.append_row((job_id, run_id, signal, at, step), at.date())


class FileAudit(Ledger):
    """One row per ingested file; its successful rows are the file state that
    decides which files are new."""

    def __init__(self, spark: SparkSession, database: str = "etl_audit", table: str = "sftp_file_audit"):
        super().__init__(spark, database, table, ddl.FILE_AUDIT, "commit_day", "date")

    def loaded(self, target_table: str | None = None) -> DataFrame:
        """``(file_path, file_size, last_modified)`` of the files already loaded. With a
        snapshot of the target's state, only audit days that it does not cover are read."""
        if target_table is None:
            return self._successes(self.read())
        until, state = self._snapshot(target_table)
        audit = self.read() if until is None else self.since(until)
        later = self._successes(audit.where(F.col("target_table") == F.lit(target_table)))
        return later if state is None else later.unionByName(state)

    @staticmethod
    def _successes(audit: DataFrame) -> DataFrame:
        done = audit.where(F.col("status") == SUCCESS)
        return done.select("file_path", F.col("file_size_bytes").alias("file_size"), F.col("last_modified_ts").alias("last_modified"))

    @property
    def _state(self) -> Ledger:
        return Ledger(self.spark, self.database, f"{self.table}_state", ddl.FILE_STATE, "target_table", "string")

    def _snapshot(self, target_table: str) -> tuple[date | None, DataFrame | None]:
        """The day up to which the newest snapshot goes, and its files."""
        book = self._state
        if not self.spark.catalog.tableExists(book.name):
            return None, None
        mine = book.visible().where(F.col("target_table") == F.lit(target_table))
        until = mine.agg(F.max("until")).first()[0]
        if until is None:
            return None, None
        return until, mine.where(F.col("until") == F.lit(until)).select("file_path", "file_size", "last_modified")

    def snapshot(self, target_table: str, until: date) -> None:
        """Write the state of a target's files as of the start of a day that is over: of each path
        the fingerprint that was loaded last. Loads then read the snapshot and later days."""
        before, state = self._snapshot(target_table)
        if before is not None and before >= until:
            return
        audit = self.read() if before is None else self.since(before)
        new = audit.where((F.col("target_table") == F.lit(target_table)) & (F.col("status") == SUCCESS)).where(
            F.to_date("load_timestamp") < F.lit(until))
        rows = new.select("file_path", F.col("file_size_bytes").alias("file_size"), F.col("last_modified_ts").alias("last_modified"),
                          F.col("load_timestamp").alias("loaded"))
        if state is not None:
            rows = rows.unionByName(state.withColumn("loaded", F.lit("")))
        latest = rows.groupBy("file_path").agg(F.max_by(F.struct("file_size", "last_modified"), F.struct("loaded", "last_modified")).alias("f"))
        book, old = self._state, []
        book.ensure()
        old = book.commits().get(target_table, [])
        book.append(latest.select("file_path", "f.file_size", "f.last_modified", F.lit(until).alias("until")), target_table)
        book.detach({target_table: old})

    def record(self, listing: DataFrame, counts: DataFrame, target_table: str, status: str = SUCCESS,
               error: str | None = None, at: datetime | None = None) -> None:
        """Append one row per listed file with its row count (0 if it has none)."""
        at = at or utc_now()
        audited = listing.join(counts, "file_path", "left").select(
            "file_name", "file_path", F.col("file_size").alias("file_size_bytes"),
            F.col("last_modified").alias("last_modified_ts"), "file_owner",
            F.lit(target_table).alias("target_table"),
            F.lit(at.strftime("%Y-%m-%d %H:%M:%S")).alias("load_timestamp"),
            F.coalesce("record_count", F.lit(0).cast("bigint")).alias("record_count"),
            F.lit(status).alias("status"), F.lit(error).cast("string").alias("error_message"),
        )
        self.append(audited, at.date())


class QualitySamples(Ledger):
    """Rows for which a batch was refused, as JSON: what a notice of it can show."""

    def __init__(self, spark: SparkSession, database: str = "etl_audit", table: str = "etl_quality_samples"):
        super().__init__(spark, database, table, ddl.QUALITY_SAMPLES, "commit_day", "date")

    def record(self, job_id: str, run_id: str, rows: DataFrame) -> None:
        """Append ``(rule, row)`` rows."""
        now = utc_now()
        self.append(rows.select(F.lit(job_id).alias("job_id"), F.lit(run_id).alias("run_id"), "rule", "row",
                                F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp").alias("recorded_at")), now.date())


class NotificationAudit(Ledger):
    """One row per notification decision; sending mail is left to others."""

    def __init__(self, spark: SparkSession, database: str = "etl_audit", table: str = "etl_email_audit"):
        super().__init__(spark, database, table, ddl.NOTIFICATIONS, "commit_day", "date")

    def record(self, notification: dict) -> None:
        notice = {"notification_id": str(uuid.uuid4()), "sent_timestamp": utc_now()} | notification
        self.append_row([notice.get(n) for n in self.fields.names], notice["sent_timestamp"].date())
