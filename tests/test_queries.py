"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as registry
from conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_registry_is_complete():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query(spark, oracle, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(str, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    relation = oracle.sql(registry.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    expected = relation.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert got == sorted(tuple(map(str, r)) for r in expected)


def test_quarantine_of_orders_without_pending_ones_in_the_first_partition(spark, tmp_path):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    for part in ("o_orderstatus <> 'P'", "o_orderstatus = 'P'"):  # a partition of the scan each, the larger one first
        orders.where(part).coalesce(1).write.mode("append").parquet(f"file:{tmp_path}/orders.parquet")
    assert spark.read.parquet(f"file:{tmp_path}/orders.parquet").rdd.getNumPartitions() == 2
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    expected = connection.execute(registry.oracle_sql()["load_quarantine"]).fetchall()
    got = registry.queries()["load_quarantine"](spark, f"file:{tmp_path}").select("what", "k", "detail").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_entry(spark):
    assert registry.entry(spark).count() > 0
