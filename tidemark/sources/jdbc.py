"""JDBC table scans for Oracle, MySQL, PostgreSQL and SQL Server."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import require_columns
from tidemark.operators.transform import project
from tidemark.operators.watermark import Watermark
from tidemark.sources.splits import equal_splits, ordered


class ConnectionSettingsError(ValueError):
    """A connection's settings are incomplete."""


@dataclass(frozen=True)
class Dialect:
    name: str
    driver: str
    port: int
    url: str
    database_settings: tuple[str, ...] = ("DATABASE", "DB")
    schema_is_database: bool = True


# Driver classes, default ports and URL formats of the four databases.
DIALECTS = {
    "oracle": Dialect(
        "oracle", "oracle.jdbc.OracleDriver", 1521, "jdbc:oracle:thin:@//{host}:{port}/{database}",
        ("SERVICE_NAME", "SID"), False,
    ),
    "mysql": Dialect(
        "mysql", "com.mysql.cj.jdbc.Driver", 3306,
        "jdbc:mysql://{host}:{port}/{database}",
    ),
    "postgres": Dialect("postgres", "org.postgresql.Driver", 5432, "jdbc:postgresql://{host}:{port}/{database}"),
    "sqlserver": Dialect(
        "sqlserver", "com.microsoft.sqlserver.jdbc.SQLServerDriver", 1433,
        "jdbc:sqlserver://{host}:{port};databaseName={database}",
    ),
}
DIALECT_ALIASES = {"postgresql": "postgres", "mssql": "sqlserver"}

DEFAULT_FETCH_SIZE = 10000


def dialect(name: str) -> Dialect:
    key = name.strip().lower()
    try:
        return DIALECTS[DIALECT_ALIASES.get(key, key)]
    except KeyError:
        raise ValueError(f"no JDBC dialect {name!r}; known: {sorted([*DIALECTS, *DIALECT_ALIASES])}") from None


@dataclass(frozen=True)
class Connection:
    """Where and as whom to connect. The password never shows in ``repr``."""

    name: str
    url: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)

    def options(self) -> dict[str, str]:
        out = {"url": self.url, "driver": self.driver}
        if self.user:
            out |= {"user": self.user, "password": self.password}
        return out


def connection_from_env(name: str, kind: str, schema: str = "", env: Mapping[str, str] | None = None) -> Connection:
    """Settings ``<NAME>_JDBC_URL`` or ``<NAME>_HOST/_PORT/_DATABASE``, plus
    ``<NAME>_USERNAME``, ``<NAME>_PASSWORD`` and optionally ``<NAME>_DRIVER``."""
    env = os.environ if env is None else env
    prefix = name.strip().upper().replace("-", "_")
    if not prefix:
        raise ConnectionSettingsError("the source names no connection")
    rules = dialect(kind)

    def setting(*suffixes: str) -> str:
        return next((v.strip() for s in suffixes if (v := env.get(f"{prefix}_{s}", "")).strip()), "")

    url = setting("JDBC_URL")
    if not url:
        host = setting("HOST")
        database = setting(*rules.database_settings) or (schema if rules.schema_is_database else "")
        if not host or not database:
            raise ConnectionSettingsError(f"connection {name!r}: set {prefix}_JDBC_URL, or {prefix}_HOST and "
                                   f"{prefix}_{rules.database_settings[0]}")
        url = rules.url.format(host=host, port=setting("PORT") or rules.port, database=database)
    user, password = setting("USERNAME", "USER"), setting("PASSWORD")
    for value, suffix in ((user, "USERNAME"), (password, "PASSWORD")):
        if not value:
            raise ConnectionSettingsError(f"connection {name!r}: {prefix}_{suffix} is not set")
    return Connection(name, url, setting("DRIVER") or rules.driver, user, password)


@dataclass(frozen=True)
class JdbcOptions:
    partition_column: str | None = None
    lower_bound: str | None = None
    upper_bound: str | None = None
    num_partitions: int = 4
    fetch_size: int = DEFAULT_FETCH_SIZE
    split: str = "width"  # ranges of equal width, or of about equally many rows


def table_name(schema: str | None, table: str) -> str:
    schema = (schema or "").strip()
    return f"{schema}.{table.strip()}" if schema else table.strip()


def newer_sql(watermark: Watermark, url: str) -> str | None:
    """The watermark condition as SQL text, for the bounds query."""
    if watermark.value in (None, "") or watermark.overlap:
        return None
    value = str(watermark.value).replace("'", "''")
    if watermark.kind == "date":
        value = value[:10]  # the stored value of a timestamp column has a time
    if watermark.kind == "numeric":
        return f"{watermark.column} > {float(value) if not value.lstrip('-').isdigit() else value}"
    typed = "" if url.startswith("jdbc:sqlserver") else "DATE " if watermark.kind == "date" else "TIMESTAMP "
    return f"{watermark.column} > {typed}'{value}'"


def stride_bounds(
    spark: SparkSession, base: Mapping[str, str], table: str, column: str, where: str | None = None
) -> tuple[str, str] | None:
    """Smallest and largest value of the split column, computed by the database
    (one row comes back); None if there is no row."""
    condition = f" WHERE {where}" if where else ""
    row = (
        spark.read.format("jdbc").options(**base)
        .option("query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}{condition}")
        .load().select(F.col("lo").cast("string"), F.col("hi").cast("string")).first()
    )
    return None if row is None or row[0] is None else (row[0], row[1])


def scan(
    spark: SparkSession,
    connection: Connection,
    table: str,
    options: JdbcOptions = JdbcOptions(),
    columns: Iterable[str] | None = None,
    watermark: Watermark | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A lazy table scan.

    * ``columns`` and the watermark filter are DataFrame operations; Spark sends
      both to the database in its dialect.
    * With a split column the read is ``num_partitions`` range queries; missing
      bounds are asked from the database, so no range is guessed. An incremental
      scan asks for the bounds of the new rows: they would else share the last
      ranges of the whole table.
    * With ``split = "rows"`` the ranges have about equally many rows instead: the split
      column (or several, by commas) is read once for its quantiles.
    * ``predicates`` splits by arbitrary disjoint conditions instead.
    """
    base = connection.options() | {"fetchsize": str(options.fetch_size)}
    if options.split == "rows" and options.partition_column and not predicates:
        split_by = [c.strip().strip('"`[]') for c in options.partition_column.split(",")]
        known = spark.read.format("jdbc").options(**base).option("dbtable", table).load()
        texts = [c for c in require_columns(known.columns, split_by) if not ordered(known.schema[c].dataType)]
        if texts:
            raise ValueError(f"a split by rows needs numbers, dates or times; {texts} follow the database's order of texts")
        known = watermark.newer(known) if watermark else known
        predicates = [s.sql for s in equal_splits(known, split_by, options.num_partitions, not connection.url.startswith("jdbc:sqlserver"))]
    if predicates:
        url = base.pop("url")
        df = spark.read.jdbc(url, table, predicates=list(predicates), properties=base)
    else:
        reader = spark.read.format("jdbc").options(**base).option("dbtable", table)
        if options.partition_column:
            bounds = (options.lower_bound, options.upper_bound)
            if None in bounds:
                where = newer_sql(watermark, connection.url) if watermark else None
                found = stride_bounds(spark, base, table, options.partition_column, where) or (None, None)
                bounds = tuple(given if given is not None else asked for given, asked in zip(bounds, found))
            if None not in bounds:
                reader = reader.options(
                    partitionColumn=options.partition_column.strip('"`[]'),
                    lowerBound=str(bounds[0]),
                    upperBound=str(bounds[1]),
                    numPartitions=str(options.num_partitions),
                )
        df = reader.load()
    if watermark:
        df = watermark.newer(df)
    return project(df, columns)
