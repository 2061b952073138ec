"""Targets in a catalog whose tables are transactional (an Iceberg catalog, say):
the catalog's own row-level operations and maintenance procedures are used.

Needs a catalog plugin configured as ``spark.sql.catalog.<name>``; none ships with
Spark, so here only the statements and the calls made are tested.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.names import identifier, utc_now
from tidemark.functions.partitioning import Partitioning
from tidemark.operators.merge import on_keys
from tidemark.operators.schema import add_columns_ddl, additions


def has_plugin(spark: SparkSession, catalog: str) -> bool:
    return bool(catalog) and spark.conf.get(f"spark.sql.catalog.{catalog}", None) is not None


class NativeTable:
    def __init__(self, spark: SparkSession, catalog: str, database: str, table: str,
                 partition: Partitioning | None = None, provider: str = "iceberg"):
        self.spark, self.catalog, self.database, self.table = spark, catalog, database, table
        self.partition, self.provider = partition, provider
        self.name = identifier(catalog, database, table)

    def ensure_database(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {identifier(self.catalog, self.database)}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def schema(self) -> T.StructType:
        return self.read().schema

    def reconcile(self, batch: T.StructType, evolution: bool = True, add_columns: bool = True) -> list[str]:
        new = additions(batch, self.schema(), evolution, add_columns)
        if new:
            self.spark.sql(add_columns_ddl(self.name, new))
        return [f.name for f in new]

    def create(self, df: DataFrame) -> None:
        writer = df.writeTo(self.name).using(self.provider)
        if self.partition:
            writer = writer.partitionedBy(*self.partition.native())
        writer.create()

    def replace(self, df: DataFrame) -> None:
        df.writeTo(self.name).overwrite(F.lit(True))

    def overwrite_partitions(self, df: DataFrame) -> None:
        df.writeTo(self.name).overwritePartitions()

    def append(self, df: DataFrame) -> None:
        df.writeTo(self.name).append()

    def merge(self, source: DataFrame, keys: Iterable[str], preserve: Iterable[str] = ()) -> None:
        kept = {c.casefold() for c in preserve}
        merged = source.alias("source").mergeInto(self.name, on_keys(keys, self.name, "source"))
        if kept:
            assigned = {c: F.col(f"source.`{c}`") for c in source.columns if c.casefold() not in kept}
            merged = merged.whenMatched().update(assigned)
        else:
            merged = merged.whenMatched().updateAll()
        merged.whenNotMatched().insertAll().merge()

    def _call(self, procedure: str, *arguments: str) -> str:
        listed = ", ".join((f"table => '{self.database}.{self.table}'", *arguments))
        statement = f"CALL {self.catalog}.system.{procedure}({listed})"
        self.spark.sql(statement)
        return statement

    def compact(self, target_mb: int = 128, rewrite_manifests: bool = True) -> list[str]:
        size = f"options => map('target-file-size-bytes', '{target_mb * 1024 * 1024}')"
        done = [self._call("rewrite_data_files", size)]
        if rewrite_manifests:
            done.append(self._call("rewrite_manifests"))
        return done

    def _older_than(self, days: float, now: datetime | None) -> str:
        return f"older_than => TIMESTAMP '{(now or utc_now()) - timedelta(days=days):%Y-%m-%d %H:%M:%S}'"

    def remove_orphans(self, older_than_days: float = 3, now: datetime | None = None) -> str:
        return self._call("remove_orphan_files", self._older_than(older_than_days, now))

    def expire(self, older_than_days: float = 3, now: datetime | None = None) -> str:
        return self._call("expire_snapshots", self._older_than(older_than_days, now))

    def refresh(self) -> None:
        self.spark.catalog.refreshTable(self.name)
