"""Parquet target tables: create, evolve, replace, overwrite partitions, append, merge.

A write never touches files a reader may be using. The new data is *staged* in a
folder of its own next to the table; publishing then points the table (or the
partitions concerned) at that folder with ``ALTER TABLE``. Nothing is written
twice, a failed run leaves the table as it was, and the folders that are no
longer referenced are what ``tidemark.sinks.maintenance`` cleans up.

An unpartitioned table switches atomically. Partitions switch one by one, so a
query planned in between may see some old and some new ones; a catalog with
transactional tables (``tidemark.sinks.native``) has no such window.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidemark.functions.columns import any_null, col, find_column, require_columns
from tidemark.functions.names import identifier, sql_text, unique
from tidemark.functions.partitioning import Partitioning, PartitionRule, PartitionRules
from tidemark.operators.merge import by_rows, touched_values, unmatched, update_matched
from tidemark.operators.quality import duplicate_keys
from tidemark.operators.schema import SchemaError, add_columns_ddl, additions, conform
from tidemark.sinks import ddl
from tidemark.sinks.places import delete_path, make_folder

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_STATEMENT_PARTITIONS = 200
_STATEMENTS_AT_ONCE = 16
#: Files that a task of a partitioned write has open at once.
_OPEN_FILES = 32
#: Rows of a file. A task that reads alike rows has a whole row group of them, by size up to 15 million.
_FILE_ROWS = 1_000_000
_UNKNOWN = object()


class MergeError(Exception):
    """The source of a merge is ambiguous."""


@dataclass
class Staged:
    """A written but unpublished folder."""

    path: str
    schema: T.StructType
    rule: Partitioning | None = None
    metrics: dict = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        """With the physical partition column, if there is one."""
        return spark.read.schema(self.schema).parquet(self.path)

    def tagged(self, spark: SparkSession, tag: str, value: str) -> Staged:
        """The rows with a value of the tag column they were staged with; there may be none."""
        path = f"{self.path}/{tag}={value}"
        make_folder(spark, path)
        return replace(self, path=path)

    def rows(self, spark: SparkSession) -> DataFrame:
        df = self.read(spark)
        return self.rule.drop_from(df) if self.rule else df

    def partitions(self, spark: SparkSession) -> dict[str, str]:
        """``{'column=value': folder}`` (``'a=1/b=2'`` of several columns) from the file
        listing; no file is opened. As many as the batch has partitions."""
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").load(self.path)
        )
        folders = [r[0] for r in files.select(F.regexp_extract("path", "^(.*)/", 1)).distinct().collect()]
        depth = len(self.rule.names) if self.rule else 1
        return {"/".join(folder.split("/")[-depth:]): folder for folder in folders}


class ParquetTable:
    """A catalog table on parquet files, optionally partitioned by one rule or several."""

    def __init__(self, spark: SparkSession, database: str, table: str, partition: Partitioning | None = None):
        self.spark = spark
        self.database, self.table = database, table
        self.name = identifier(database, table)
        self._declared, self._stored = partition, _UNKNOWN

    # -- catalog ---------------------------------------------------------

    def ensure_database(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {identifier(self.database)}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    @property
    def partition(self) -> Partitioning | None:
        """The existing table's rule; the declared one for a table to be created."""
        if self._stored is _UNKNOWN and self.exists():
            self._stored = self._stored_rule()
        return self._declared if self._stored is _UNKNOWN else self._stored

    def _stored_rule(self) -> Partitioning | None:
        properties = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        if ddl.PARTITION_PROPERTY in properties:
            return ddl.rule_from_text(properties[ddl.PARTITION_PROPERTY])
        found = [c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition]
        rules = tuple(PartitionRule("identity", c) for c in found)
        return PartitionRules(rules) if len(rules) > 1 else rules[0] if rules else None

    @property
    def versions(self) -> str:
        """Folder that holds one subfolder per staged version."""
        base = self.spark.catalog.getDatabase(self.database).locationUri
        return f"{base.rstrip('/')}/{self.table}__versions"

    @property
    def location(self) -> str:
        """The folder the table itself points at."""
        lines = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect()
        return next(r["data_type"] for r in lines if r["col_name"] == "Location").rstrip("/")

    def schema(self) -> T.StructType:
        return self.read().schema

    def read(self) -> DataFrame:
        """The table without its derived partition column."""
        df, rule = self.spark.table(self.name), self.partition
        return rule.drop_from(df) if rule else df

    def refresh(self) -> None:
        self.spark.catalog.refreshTable(self.name)

    def reconcile(self, batch: T.StructType, evolution: bool = True, add_columns: bool = True) -> list[str]:
        """Add the batch's new columns to the table; raises if it does not fit."""
        new = additions(batch, self.schema(), evolution, add_columns)
        if new:
            self.spark.sql(add_columns_ddl(self.name, new))
        return [f.name for f in new]

    # -- staging ---------------------------------------------------------

    def stage(self, df: DataFrame, metrics: Iterable[Column] = (), rebalance: bool = True, tag: str | None = None) -> Staged:
        """Write a folder in the table's layout, measuring on the way. Rows of different
        values of a ``tag`` column go to folders of their own (``tagged``), by the same write.

        For a partitioned table rows are first brought together by partition
        (``rebalance``: AQE splits large and merges small ones), or every task
        would leave a file in every partition. Metrics are observed after that
        shuffle: the last stage counts every task once, whatever is retried."""
        rule = self.partition
        out = df
        if rule:
            out = rule.add_to(out)
            if rebalance:
                out = out.hint("rebalance", *[col(n) for n in ([tag] if tag else []) + rule.names])
        measures = list(metrics)
        observation = Observation(unique("stage")) if measures else None
        if observation:
            out = out.observe(observation, *measures)
        path = f"{self.versions}/{unique('v')}"
        writer = out.write.options(compression="zstd", maxRecordsPerFile=_FILE_ROWS)
        folders = ([tag] if tag else []) + (rule.names if rule else [])
        with _unsorted(out):
            (writer.partitionBy(*folders) if folders else writer).parquet(path)
        schema = T.StructType([f for f in out.schema.fields if f.name != tag])
        return Staged(path, _partition_last(schema, rule), rule, observation.get if observation else {})

    def discard(self, staged: Staged) -> None:
        delete_path(self.spark, staged.path)

    # -- publishing ------------------------------------------------------

    def create(self, schema: T.StructType, location: str | None = None) -> None:
        """Create the table empty, or over a staged folder (nothing is moved)."""
        rule = self._declared
        derived = [r for r in rule.parts if not r.is_identity and not find_column(schema.names, r.name)] if rule else []
        full = T.StructType([*schema.fields, *[r.field(schema) for r in derived]])
        self.spark.sql(ddl.create_table(
            self.name, _partition_last(full, rule), location or f"{self.versions}/{unique('v')}",
            rule.names if rule else [], {ddl.PARTITION_PROPERTY: ddl.rule_text(rule)} if rule else None,
        ))
        if rule and location:
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def publish_new(self, staged: Staged, hidden: Iterable[str] = ()) -> None:
        """First write. ``hidden`` columns stay in the files but not in the table."""
        schema = T.StructType([f for f in staged.schema.fields if f.name not in set(hidden)])
        self.create(schema, staged.path)

    def publish_replace(self, staged: Staged) -> None:
        """The staged rows become the whole table."""
        if staged.rule is None:
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION {sql_text(staged.path)}")
            self.refresh()
            return
        incoming = staged.partitions(self.spark)
        stale = self._partition_specs() - set(incoming)
        self._point(incoming)
        self._drop(stale)

    def publish_partitions(self, staged: Staged) -> None:
        """Replace only the partitions the batch has; an unpartitioned table is
        replaced whole."""
        if staged.rule is None:
            self.publish_replace(staged)
        else:
            self._point(staged.partitions(self.spark))

    def publish_append(self, staged: Staged) -> None:
        """Add the staged rows. If they only bring new partitions, those are
        attached as they are; otherwise the batch is copied in by one insert."""
        if staged.rule is not None:
            incoming = staged.partitions(self.spark)
            if incoming and not self._partition_specs() & set(incoming):
                self._point(incoming)
                return
        self.append(staged.rows(self.spark))
        self.discard(staged)

    def append(self, df: DataFrame) -> None:
        """Insert rows directly, without staging."""
        rule = self.partition
        out = conform(df, self.schema())
        out = rule.add_to(out) if rule else out
        columns = self.spark.table(self.name).columns
        with _unsorted(out):
            out.select(*[col(c) for c in columns]).write.insertInto(self.name)

    def merge(
        self,
        source: DataFrame,
        keys: Iterable[str],
        preserve: Iterable[str] = (),
        newer_by: Sequence[str] = (),
        keys_verified: bool = False,
    ) -> Staged:
        """Upsert ``source`` and publish. It is read several times, so stage it
        first if it is not stored. Two source rows with one key are an error, as
        in MERGE; ``keys_verified`` says a quality gate has looked already.

        Only partitions that hold a matched key or receive a row are rewritten;
        which these are takes a scan of the key columns, and not even that if the
        partition follows from a key. Their rows are then read, joined and written
        once; the keys of what was written say which source rows are left to insert."""
        names = require_columns(self.schema().names, keys)
        source = conform(source, self.schema())
        if not keys_verified and duplicate_keys(source.where(~any_null(names)), names).head(1):
            raise MergeError(f"several source rows share a key {names}")
        source = by_rows(source)
        rule, scope, touched = self.partition, self.read(), set()
        if rule:
            scope, touched = self._touched(source, names, preserve)
        staged = self.stage(update_matched(scope, source, names, preserve, newer_by))
        self._stage_more(staged, unmatched(source, staged.rows(self.spark), names))
        self._publish_touched(staged, touched)
        return staged

    def replace_by(self, values: DataFrame, rows: DataFrame, column: str) -> Staged:
        """Delete the rows whose ``column`` has one of the values, insert ``rows``, and publish:
        only partitions that hold or get such rows are rewritten. Doing it again changes nothing.
        Both inputs are read several times, so store them first."""
        [name] = require_columns(self.schema().names, [column])
        values = values.select(col(require_columns(values.columns, [column])[0]).alias(name)).where(col(name).isNotNull()).distinct()
        rows = conform(rows, self.schema())
        rule, scope, touched = self.partition, self.read(), set()
        if rule:
            if any(r.column.casefold() != name.casefold() for r in rule.parts):
                raise ValueError(f"{self.name} is not partitioned by {name!r}")
            scope, touched = self._touched(values, [name], ())
        staged = self.stage(scope.join(values, name, "left_anti").select(*[col(c) for c in scope.columns]).unionByName(rows))
        self._publish_touched(staged, touched)
        return staged

    def _publish_touched(self, staged: Staged, touched: set[tuple]) -> None:
        """Publish what replaces the touched partitions; those left without a row go."""
        if staged.rule is None:
            self.publish_replace(staged)
            return
        incoming = staged.partitions(self.spark)
        emptied = {s for s in self._partition_specs() - set(incoming) if spec_values(s) in touched}
        self._point(incoming)
        self._drop(emptied)

    def _touched(self, source: DataFrame, keys: list[str], preserve: Iterable[str]) -> tuple[DataFrame, set[tuple]]:
        """The rows of the partitions a merge has to rewrite, and their values."""
        whole, rule = self.spark.table(self.name), self.partition
        physical = [col(c) for c in require_columns(whole.columns, rule.names)]
        own = [f"__partition{k}" for k in range(len(physical))]
        found = rule.add_to(source).select(*[col(n).alias(o) for n, o in zip(rule.names, own)]).distinct()
        follows = all(find_column(keys, r.column) is not None for r in rule.parts)
        if not follows:
            found = found.union(touched_values(whole, source, keys, physical, own)).distinct()
        # Partition values only: at most one row per partition of the table.
        rows = found.select(*own, *[F.coalesce(F.col(o).cast("string"), F.lit(_NULL_PARTITION)).alias(f"{o}_text") for o in own]).collect()
        scope = F.lit(True)
        for column, o in zip(physical, own):
            values = {r[o] for r in rows}
            inside = column.isin(sorted(v for v in values if v is not None))
            scope = scope & (inside | column.isNull() if None in values else inside)
        touched = {tuple(r[f"{o}_text"] for o in own) for r in rows}
        if len(own) > 1:  # of several columns not every combination
            text = F.array(*[F.coalesce(c.cast("string"), F.lit(_NULL_PARTITION)) for c in physical])
            scope = scope & text.isin([F.array(*map(F.lit, t)) for t in sorted(touched)])
        return rule.drop_from(whole.where(scope)), touched

    def _stage_more(self, staged: Staged, df: DataFrame) -> None:
        """Add rows to a staged folder nobody reads yet."""
        rule = staged.rule
        if rule:
            df = rule.add_to(df).hint("rebalance", *[col(n) for n in rule.names])
        writer = df.write.mode("append").options(compression="zstd", maxRecordsPerFile=_FILE_ROWS)
        with _unsorted(df):
            (writer.partitionBy(*rule.names) if rule else writer).parquet(staged.path)

    # -- partition pointers ----------------------------------------------

    def _partition_specs(self) -> set[str]:
        return {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}

    def _point(self, folders: dict[str, str]) -> None:
        """Make every partition read from its folder."""
        known = self._partition_specs()
        fresh = [f"PARTITION ({_spec_sql(s)}) LOCATION {sql_text(p)}" for s, p in folders.items() if s not in known]
        # No statement moves several partitions, and dropping them first would hide rows
        # from readers, so the catalog gets several statements at a time.
        moves = [f"ALTER TABLE {self.name} PARTITION ({_spec_sql(s)}) SET LOCATION {sql_text(folders[s])}" for s in folders.keys() & known]
        with ThreadPoolExecutor(_STATEMENTS_AT_ONCE) as pool:
            list(pool.map(self.spark.sql, moves))
        for start in range(0, len(fresh), _STATEMENT_PARTITIONS):
            block = " ".join(fresh[start:start + _STATEMENT_PARTITIONS])
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {block}")
        self.refresh()

    def _drop(self, specs: Iterable[str]) -> None:
        """Forget partitions; the table is external, so no file is deleted."""
        parts = [f"PARTITION ({_spec_sql(s)})" for s in specs]
        for start in range(0, len(parts), _STATEMENT_PARTITIONS):
            block = ", ".join(parts[start:start + _STATEMENT_PARTITIONS])
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {block}")
        if parts:
            self.refresh()


@contextmanager
def _unsorted(df: DataFrame) -> Iterator[None]:
    """Partitioned writes of a task's rows as they come, with a file open for each partition.

    Otherwise Spark first sorts a task's rows by partition, all of them in memory. Those of a
    few compressed megabytes can be millions of rows. Only what is beyond ``_OPEN_FILES``
    partitions is sorted then. A session that has the setting keeps its own."""
    settings, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    if settings.get(name, "0") != "0":
        yield
        return
    settings.set(name, str(_OPEN_FILES))
    try:
        yield
    finally:
        settings.unset(name)


def _partition_last(schema: T.StructType, rule: Partitioning | None) -> T.StructType:
    if rule is None:
        return schema
    last = [next(f for f in schema.fields if f.name.casefold() == n.casefold()) for n in rule.names]
    return T.StructType([f for f in schema.fields if f not in last] + last)


def spec_values(spec: str) -> tuple[str, ...]:
    """The values of ``a=1/b=2``."""
    from urllib.parse import unquote

    return tuple(unquote(part.split("=", 1)[1]) for part in spec.split("/"))


def _spec_sql(spec: str) -> str:
    """``a = '1', b = '2'`` of the folder name ``a=1/b=2``."""
    names = [part.split("=", 1)[0] for part in spec.split("/")]
    return ", ".join(f"`{n}` = {sql_text(None if v == _NULL_PARTITION else v)}" for n, v in zip(names, spec_values(spec)))
