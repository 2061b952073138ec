import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.sources import jdbc
from tidemark.sources.jdbc import Connection, JdbcOptions
from tidemark.sources.splits import equal_splits
from test_jdbc import Session


def sizes(df, splits):
    """Rows of each split; every row must be in exactly one."""
    marked = df.select(F.array(*[s.condition for s in splits]).alias("c"))
    assert marked.where("exists(c, x -> x is null) or size(filter(c, x -> x)) <> 1").count() == 0
    counts = marked.groupBy(F.array_position("c", True).alias("k")).count().collect()
    found = {r["k"]: r["count"] for r in counts}
    return [found.get(k + 1, 0) for k in range(len(splits))]


def in_database(df, splits):
    """The same by the SQL texts."""
    con = duckdb.connect()
    con.register("t", df.toPandas())
    return [con.sql(f"SELECT count(*) FROM t WHERE {s.sql}").fetchall()[0][0] for s in splits]


def test_even_values(spark):
    df = spark.range(10_000).select("id")
    splits = equal_splits(df, "ID", 8)
    found = sizes(df, splits)
    assert len(splits) == 8 and max(found) < 1.1 * 1250 and found == in_database(df, splits)


def test_skewed_widths(spark):
    """Most values are small; ranges of equal width would put them in one."""
    df = spark.range(10_000).selectExpr("cast(pow(1.001, id) as bigint) as v")
    found = sizes(df, equal_splits(df, "v", 10))
    assert max(found) < 2 * 1000 and len(found) <= 12


def test_a_heavy_value_and_nulls_are_cut_by_the_second_column(spark):
    df = spark.range(12_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS v", "id AS k")
    alone = equal_splits(df, "v", 12)
    found = sizes(df, alone)
    assert sorted(found)[-2:] == [4000, 4000] and {"v = 7", "v IS NULL"} <= {s.sql for s in alone}
    both = equal_splits(df, ["v", "k"], 12)
    found = sizes(df, both)
    assert max(found) < 2 * 1000 and found == in_database(df, both) and len(both) <= 14


def test_few_values_no_rows_and_one_split(spark):
    df = spark.range(100).selectExpr("id % 2 AS v")
    assert sorted(sizes(df, equal_splits(df, "v", 16))) in ([50, 50], [0, 50, 50])
    none = df.where("v > 5")
    assert sizes(none, equal_splits(none, "v", 4)) in ([0], [0, 0])
    nulls = spark.range(9).selectExpr("cast(null as int) v")
    assert sum(sizes(nulls, equal_splits(nulls, "v", 4))) == 9
    assert sizes(df, equal_splits(df, "v", 1)) == [100]
    with pytest.raises(ValueError):
        equal_splits(df, "v", 0)


@pytest.mark.parametrize("column", ["d", "ts", "x", "s"])
def test_other_types(spark, column):
    df = spark.range(2000).selectExpr(
        "date_add(date'2024-01-01', cast(sqrt(id) as int)) d", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id*id/7) ts",
        "cast(id as double) / 3 x", "concat('it''s ', cast(id % 50 as string)) s")
    splits = equal_splits(df, column, 6)
    found = sizes(df, splits)
    assert max(found) < 2 * 2000 / 6 and found == in_database(df, splits)


def test_nan_is_in_one_split(spark):
    df = spark.range(100).selectExpr("CASE WHEN id % 4 = 0 THEN double('nan') ELSE id END AS x")
    assert sum(sizes(df, equal_splits(df, "x", 5))) == 100


def test_jdbc_reads_by_rows(spark):
    table = spark.range(1000).selectExpr("id AS k", "cast(id as string) AS name")
    session = Session(table=table)
    jdbc.scan(session, Connection("c", "jdbc:x://h", "x.Driver", "u", "p"), "t", JdbcOptions("k", num_partitions=4, split="rows"))
    assert session.log[0]["dbtable"] == "t" and len(session.log[1]["predicates"]) == 4
    assert session.log[1]["predicates"][0].startswith("k <= ")
    with pytest.raises(ValueError, match="order of texts"):
        jdbc.scan(Session(table=table), Connection("c", "jdbc:x://h", "x.Driver"), "t", JdbcOptions("name", split="rows"))
