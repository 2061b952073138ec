"""What one load is made of, read from a nested dictionary or a TOML file."""

from __future__ import annotations

import os
import re
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from tidemark.functions.partitioning import Partitioning, PartitionRule, PartitionRules
from tidemark.operators.ledger import RoutingRule
from tidemark.operators.quality import QualityRules
from tidemark.operators.transform import AggregateRules, AuditColumns, TransformRules
from tidemark.sources.jdbc import DEFAULT_FETCH_SIZE, DIALECT_ALIASES, DIALECTS, JdbcOptions

LOAD_TYPES = ("full", "incremental", "upsert")
PRELOAD_OPERATIONS = ("validate_source", "validate_target", "check_watermark")
POSTLOAD_OPERATIONS = (
    "update_watermark", "refresh_metadata", "compact_table", "compact_small_files",
    "remove_orphan_files", "cleanup_orphan_files", "expire_snapshots",
)


_BOOLEANS = {"true": True, "yes": True, "1": True, "false": False, "no": False, "0": False}
_TOKEN = re.compile(r"\$\{(?P<name>[A-Za-z_][A-Za-z0-9_]*)(?P<rest>:[^}]*)?\}")


class SpecError(ValueError):
    """The spec is incomplete or contradicts itself."""


class _Section:
    """Typed access to one table of the spec; the first name present wins."""

    def __init__(self, name: str, values):
        if not isinstance(values, Mapping):
            raise SpecError(f"[{name}] must be a table")
        self.name, self.values = name, values

    def raw(self, *names, default=None):
        return next((self.values[n] for n in names if self.values.get(n) not in (None, "")), default)

    def text(self, *names, default: str = "") -> str:
        return str(self.raw(*names, default=default)).strip()

    def required(self, *names) -> str:
        value = self.raw(*names)
        if not isinstance(value, str) or not value.strip():
            raise SpecError(f"[{self.name}] needs a non-empty {' or '.join(names)}")
        return value.strip()

    def flag(self, *names, default: bool | None = True):
        """A boolean; a text must say true or false, as values from the environment do."""
        value = self.raw(*names)
        if isinstance(value, str) and value.strip().lower() in _BOOLEANS:
            value = _BOOLEANS[value.strip().lower()]
        if value is not None and not isinstance(value, bool):
            raise SpecError(f"[{self.name}] {names[0]} must be true or false, not {value!r}")
        return default if value is None else value

    def number(self, *names, default: int, positive: bool = False) -> int:
        try:
            value = int(self.raw(*names, default=default))
        except (TypeError, ValueError):
            return default
        return default if positive and value <= 0 else value

    def names(self, *names, commas: bool = False) -> tuple[str, ...]:
        """A list of names; a single one may be given as text."""
        value = self.raw(*names, default=())
        if isinstance(value, str):
            value = value.split(",") if commas else [value]
        if not isinstance(value, (list, tuple)):
            return ()
        return tuple(t for v in value if (t := str(v).strip()))

    def mapping(self, name: str) -> dict[str, str]:
        value = self.values.get(name)
        return {str(k).strip(): str(v).strip() for k, v in value.items()} if isinstance(value, Mapping) else {}

    def sub(self, name: str, fallback: Mapping | None = None) -> _Section:
        """A nested table; missing keys may come from a flat form of it."""
        nested = self.values.get(name, {})
        if not isinstance(nested, Mapping):
            raise SpecError(f"[{self.name}.{name}] must be a table")
        return _Section(f"{self.name}.{name}", {**(fallback or {}), **nested})


@dataclass(frozen=True)
class Task:
    id: str
    name: str
    enabled: bool = True
    description: str = ""
    depends_on: tuple[str, ...] = ()
    sla_seconds: int = 0  # a longer run is reported; 0 is no limit
    signals: bool = False  # whether starts, steps and ends are recorded as they happen


@dataclass(frozen=True)
class FeedOptions:
    path: str = ""
    pattern: str = "*.csv"
    format: str = "csv"
    delimiter: str = ","
    header: bool = True
    encoding: str = "utf-8"
    audit_table: str = ""  # of the form [database.]table; the state database's default without
    schema: str | None = None  # declared columns; types are inferred without
    recursive: bool = True
    bad_rows: str = "fail"  # rows that do not fit their file's columns: fail | keep | quarantine
    bad_share: float = 0.1  # a file with a larger share of such rows is refused
    bad_limit: int = 0  # so is one with more of them; 0 is no limit
    rejected_table: str = ""  # where they go; the target's name and _rejected without


@dataclass(frozen=True)
class Source:
    type: str
    connection: str
    schema: str
    table: str
    columns: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    jdbc: JdbcOptions = JdbcOptions()
    feed: FeedOptions = FeedOptions()

    @property
    def is_feed(self) -> bool:
        return self.type == "sftp"

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.table}"


@dataclass(frozen=True)
class Load:
    type: str
    watermark_column: str | None = None
    watermark_type: str = "timestamp"
    initial_watermark: str | None = None
    merge_keys: tuple[str, ...] = ()
    overwrite: str | None = None  # what a full load replaces: all | partitions
    preserve: tuple[str, ...] = ()
    overlap: str | None = None  # how far before the watermark to read again
    ties: bool = True  # an append loads rows that come late with the watermark's own value

    @property
    def is_incremental(self) -> bool:
        return self.type != "full"

    @property
    def keeps_ties(self) -> bool:
        """For appends; an upsert may read an overlap again."""
        return self.is_incremental and self.ties and not self.merge_keys


@dataclass(frozen=True)
class Maintenance:
    enabled: bool = True
    compact_small_files: bool = True
    target_file_size_mb: int = 128
    rewrite_manifests: bool = True
    orphan_file_retention_days: int = 3


@dataclass(frozen=True)
class Target:
    catalog: str
    database: str
    table: str
    partition: Partitioning | None = None
    maintenance: Maintenance = Maintenance()
    kind: str = "iceberg"

    def replaces_all(self, load: Load) -> bool:
        """Whether a full load replaces every row: unless the spec says partitions.
        It always reads the whole source, of a feed all its files."""
        return load.overwrite != "partitions"

    @property
    def full_name(self) -> str:
        return ".".join(p for p in (self.catalog, self.database, self.table) if p)


@dataclass(frozen=True)
class Evolution:
    evolution: bool = True
    add_columns: bool = True


@dataclass(frozen=True)
class Hooks:
    enabled: bool = True
    operations: tuple[str, ...] = ()


@dataclass(frozen=True)
class Notify:
    enabled: bool = False
    sender: str = ""
    recipients: tuple[str, ...] = ()
    rules: tuple[RoutingRule, ...] = ()
    copies: tuple[str, ...] = ()
    subject: str = ""


@dataclass(frozen=True)
class LoadSpec:
    task: Task
    source: Source
    load: Load
    target: Target
    primary_key: tuple[str, ...] = ()
    transform: TransformRules = TransformRules()
    aggregate: AggregateRules = AggregateRules()
    audit: AuditColumns = AuditColumns()
    evolution: Evolution = Evolution()
    preload: Hooks = Hooks()
    postload: Hooks = Hooks()
    quality: QualityRules = QualityRules()
    notify: Notify = Notify()
    raw: Mapping = field(default_factory=dict, repr=False, compare=False)

    @classmethod
    def from_dict(cls, data: Mapping, env: Mapping[str, str] | None = None) -> LoadSpec:
        if not isinstance(data, Mapping):
            raise SpecError("the spec must be a table")
        data = substitute_env(data, env)
        root = _Section("spec", data)
        if not (data.get("task") or data.get("job")):
            raise SpecError("the spec needs a [task] or [job] section")
        for name in ("source", "load", "target"):
            if name not in data:
                raise SpecError(f"the spec needs a [{name}] section")
        keys = _Section("keys", data.get("keys", {}))
        primary = keys.names("primary_key", "primary_keys")
        load = _load(_Section("load", data["load"]), keys.names("merge_keys", "merge_key"), primary)
        return cls(
            task=_task(_Section("task", root.raw("task", "job"))),
            source=_source(_Section("source", data["source"]), data.get("jdbc")),
            load=load,
            target=_target(_Section("target", data["target"])),
            primary_key=primary,
            transform=_transform(_Section("transform", data.get("transform", {}))),
            aggregate=_aggregate(_Section("aggregate", data.get("aggregate", {}))),
            audit=_audit(_Section("audit", root.raw("audit_columns", "audit", default={}))),
            evolution=_evolution(_Section("schema", data.get("schema", {}))),
            preload=_hooks(_Section("preload", data.get("preload", {})), ("validate_source", "validate_target")),
            postload=_hooks(_Section("postload", data.get("postload", {})), ("update_watermark", "compact_table")),
            quality=_quality(_Section("quality", root.raw("data_quality", "quality", default={}))),
            notify=_notify(_Section("email", root.raw("email_notification", "email", default={}))),
            raw=data,
        )

    @classmethod
    def from_toml(cls, path: str | Path, env: Mapping[str, str] | None = None) -> LoadSpec:
        file = Path(path)
        if not file.is_file():
            raise SpecError(f"no spec file {path}")
        try:
            return cls.from_dict(tomllib.loads(file.read_text(encoding="utf-8")), env)
        except tomllib.TOMLDecodeError as problem:
            raise SpecError(f"{path}: {problem}") from problem


def substitute_env(value, env: Mapping[str, str] | None = None):
    """``${NAME}`` and ``${NAME:default}`` in all texts of a spec."""
    env = os.environ if env is None else env
    if isinstance(value, str):
        return _TOKEN.sub(lambda token: env.get(token["name"], (token["rest"] or ":")[1:]), value)
    nested = value.items() if isinstance(value, Mapping) else enumerate(value) if isinstance(value, list) else None
    if nested is None:
        return value
    done = {key: substitute_env(item, env) for key, item in nested}
    return done if isinstance(value, Mapping) else list(done.values())


def _task(s: _Section) -> Task:
    return Task(
        s.required("task_id", "job_id"), s.required("task_name", "job_name"), s.flag("enabled"),
        s.text("description"), s.names("depends_on", commas=True), s.number("sla_seconds", default=0),
        s.flag("signals", default=False),
    )


def _source(s: _Section, top_level_jdbc) -> Source:
    kind = s.required("type").lower()
    kind = DIALECT_ALIASES.get(kind, kind)
    if kind not in (*DIALECTS, "sftp", "table"):
        raise SpecError(f"[source] unknown type {kind!r}")
    extraction = s.sub("extraction")
    flat = {k: v for k, v in s.values.items() if not isinstance(v, Mapping) and k not in ("schema", "type", "table")}
    feed = s.sub("sftp", flat)
    if kind == "sftp" and feed.text("file_format", "format", default="csv").lower() != "csv":
        raise SpecError("[source] a feed's file_format must be csv")
    jdbc = s.sub("jdbc", top_level_jdbc if isinstance(top_level_jdbc, Mapping) else None)

    def bound(name):
        try:
            return str(int(jdbc.values[name]))
        except (KeyError, TypeError, ValueError):
            return None

    return Source(
        kind, s.required("connection"), s.required("schema"), s.required("table"),
        extraction.names("columns"), extraction.names("exclude_columns", "exclude"),
        JdbcOptions(
            jdbc.text("partition_column", "split_column") or None, bound("lower_bound"), bound("upper_bound"),
            jdbc.number("num_partitions", "partitions", default=4, positive=True),
            jdbc.number("fetch_size", "fetchsize", default=DEFAULT_FETCH_SIZE, positive=True),
            _one_of(jdbc, "split", "width", "rows"),
        ),
        FeedOptions(
            path=feed.required("path", "directory") if kind == "sftp" else "",
            pattern=feed.text("file_pattern", "pattern", default="*.csv"),
            format=feed.text("file_format", "format", default="csv").lower(),
            delimiter=str(feed.raw("delimiter", default=",")) or ",",
            header=feed.flag("header"),
            encoding=feed.text("encoding", default="utf-8"),
            audit_table=feed.text("audit_table"),
            schema=feed.text("columns_ddl") or None,
            recursive=feed.flag("recursive"),
            bad_rows=_one_of(feed, "bad_rows", "fail", "keep", "quarantine"),
            bad_share=_share(feed, "bad_share", 0.1),
            bad_limit=feed.number("bad_limit", default=0),
            rejected_table=feed.text("rejected_table"),
        ),
    )


def _one_of(s: _Section, name: str, *choices: str) -> str:
    """A setting with a few values, the first of them by default."""
    value = s.text(name, default=choices[0]).lower()
    if value not in choices:
        raise SpecError(f"[{s.name}] {name} must be one of {list(choices)}, not {value!r}")
    return value


def _share(s: _Section, name: str, default: float) -> float:
    try:
        value = float(s.raw(name, default=default))
    except (TypeError, ValueError):
        value = -1.0
    if not 0 <= value <= 1:
        raise SpecError(f"[{s.name}] {name} must be a share from 0 to 1")
    return value


def _load(s: _Section, key_section: tuple[str, ...], primary: tuple[str, ...]) -> Load:
    kind = s.required("type").lower()
    if kind not in LOAD_TYPES:
        raise SpecError(f"[load] unknown type {kind!r}; known: {list(LOAD_TYPES)}")
    step = s.sub("incremental")
    column = step.text("column", "watermark_column") or s.text("watermark_column") or None
    if kind != "full" and not column:
        raise SpecError(f"[load] type {kind!r} needs incremental.column")
    own_keys = s.names("merge_keys", "merge_key")
    if kind == "upsert" and not (own_keys or key_section or primary):
        raise SpecError("[load] type 'upsert' needs merge_keys")
    keys = own_keys or key_section or (primary if kind == "upsert" else ())
    watermark_type = step.text("watermark_type", default="timestamp").lower()
    options = s.values.get("options") if isinstance(s.values.get("options"), Mapping) else {}
    initial = options.get("initial_watermark")
    overwrite = options.get("overwrite")
    if overwrite not in (None, "all", "partitions"):
        raise SpecError(f"[load.options] overwrite must be all or partitions, not {overwrite!r}")
    overlap = options.get("overlap")
    if overlap and not keys:
        raise SpecError("[load.options] overlap needs merge keys, or rows would repeat")
    ties = options.get("ties", "keep")
    if ties not in ("keep", "lose"):
        raise SpecError(f"[load.options] ties must be keep or lose, not {ties!r}")
    return Load(
        kind, column, watermark_type if watermark_type in ("timestamp", "numeric", "date") else "timestamp",
        None if initial is None else str(initial), keys, overwrite,
        _Section("load.options", options).names("preserve"), str(overlap) if overlap else None, ties == "keep",
    )


def _target(s: _Section) -> Target:
    kind = s.text("type", default="iceberg").lower()
    if kind not in ("iceberg", "parquet"):
        raise SpecError(f"[target] unknown type {kind!r}")
    partition, upkeep = s.sub("partition"), s.sub("maintenance")
    defaults = Maintenance()
    return Target(
        s.required("catalog"), s.required("database"), s.required("table"),
        PartitionRules.parse(partition.text("by")) or PartitionRule.parse(partition.text("type"), partition.text("column") or None),
        Maintenance(
            upkeep.flag("enabled"), upkeep.flag("compact_small_files"),
            upkeep.number("target_file_size_mb", default=defaults.target_file_size_mb, positive=True),
            upkeep.flag("rewrite_manifests"),
            upkeep.number("orphan_file_retention_days", default=defaults.orphan_file_retention_days),
        ),
        kind,
    )


def _transform(s: _Section) -> TransformRules:
    return TransformRules(s.names("exclude"), s.mapping("rename"), s.mapping("cast"), s.mapping("derived"))


def _aggregate(s: _Section) -> AggregateRules:
    rules = AggregateRules(s.names("keys", "group_by"), s.mapping("columns"))
    if s.values and not rules.columns:
        raise SpecError("[aggregate.columns] needs a SQL aggregate for each result column")
    return rules


def _audit(s: _Section) -> AuditColumns:
    d = AuditColumns()
    return AuditColumns(
        s.flag("enabled"),
        s.text("insert_ts_column", "insert_timestamp", default=d.insert_ts),
        s.text("updated_ts_column", "updated_timestamp", default=d.updated_ts),
        s.text("run_id_column", "job_id_column", "etl_run_id", default=d.run_id),
        s.text("job_user_column", "source_system_column", "source_system", default=d.job_user),
        s.text("timezone", default=d.timezone),
    )


def _evolution(s: _Section) -> Evolution:
    return Evolution(s.flag("evolution"), s.flag("add_columns"))


def _hooks(s: _Section, default: tuple[str, ...]) -> Hooks:
    return Hooks(s.flag("enabled"), s.names("operations") if "operations" in s.values else default)


def _quality(s: _Section) -> QualityRules:
    return QualityRules(
        s.flag("enabled"), s.names("null_check"), s.names("unique_check"), s.number("minimum_rows", default=0),
        s.flag("check_null_keys", default=None), s.flag("check_duplicate_keys", default=None),
    )


def _notify(s: _Section) -> Notify:
    events = s.raw("events", default=[])
    if isinstance(events, Mapping):
        events = [{**v, "event": k} for k, v in events.items() if isinstance(v, Mapping)]
    rules = []
    for event in events:
        if isinstance(event, Mapping):
            e = _Section("email.events", event)
            rules.append(RoutingRule(
                e.text("event", default="on_failure").lower(), e.names("to", commas=True), e.flag("enabled"),
                e.text("template").lower(),
            ))
    return Notify(s.flag("enabled", default=False), s.text("from", "sender"), s.names("to", commas=True),
                  tuple(rules), copies=s.names("cc", commas=True), subject=s.text("subject"))
