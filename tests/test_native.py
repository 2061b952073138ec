"""Statements for transactional catalogs; the session only records them."""

import datetime as dt

from tidemark.functions.partitioning import PartitionRule
from tidemark.sinks import ddl
from tidemark.sinks.native import NativeTable, has_plugin
from tidemark.sinks.tables import ParquetTable


class Recorder:
    def __init__(self):
        self.statements = []

    def sql(self, statement):
        self.statements.append(statement)


def test_maintenance_calls():
    table = NativeTable(Recorder(), "hive", "edw", "customer")
    assert table.compact(64) == [
        "CALL hive.system.rewrite_data_files(table => 'edw.customer', options => map('target-file-size-bytes', '67108864'))",
        "CALL hive.system.rewrite_manifests(table => 'edw.customer')"]
    assert len(table.compact(64, rewrite_manifests=False)) == 1
    now = dt.datetime(2024, 1, 10)
    assert table.remove_orphans(3, now).endswith("remove_orphan_files(table => 'edw.customer', older_than => TIMESTAMP '2024-01-07 00:00:00')")
    assert "expire_snapshots" in table.expire(now=now)
    table.ensure_database()
    assert table.spark.statements[-1] == "CREATE DATABASE IF NOT EXISTS `hive`.`edw`"


def test_native_partition_transforms(spark):
    texts = {k: str(PartitionRule.parse(k, "ts").native()) for k in ("days", "hour", "month", "years", "bucket(4)", "identity")}
    assert "days(ts)" in texts["days"] and "hours" in texts["hour"] and "months" in texts["month"] and "years" in texts["years"]
    assert "bucket" in texts["bucket(4)"] and "ts" in texts["identity"]


def test_merge_statement_is_built_for_any_catalog(spark, orders):
    from tidemark.operators.merge import on_keys

    condition = str(on_keys(["a", "b"], "t", "s"))
    assert "t.a" in condition and "s.b" in condition


def test_plugin_detection(spark):
    assert not has_plugin(spark, "hive") and not has_plugin(spark, "")


def test_bronze_and_governance_tables(spark, database):
    from pyspark.sql import types as T

    for name, (columns, kind, column) in ddl.BRONZE.items():
        table = ParquetTable(spark, database, name, PartitionRule.parse(kind, column))
        table.create(T.StructType.fromDDL(columns))
        assert table.read().count() == 0 and table.partition.kind == "day"
    customer = ParquetTable(spark, database, "customer")
    seed = spark.createDataFrame(
        [(1, "ann", "ACTIVE", None, dt.datetime(2024, 1, 2, 3), None, None, "r", "u")], T.StructType.fromDDL(ddl.BRONZE["customer"][0]))
    customer.append(seed)
    assert customer.read().count() == 1 and customer._partition_specs() == {"updated_at_day=2024-01-02"}
