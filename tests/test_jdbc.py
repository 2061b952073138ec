"""JDBC scans are tested by the options they give to Spark; no database is used."""

import pytest

from tidemark.operators.watermark import Watermark
from tidemark.sources import jdbc
from tidemark.sources.jdbc import Connection, JdbcOptions, connection_from_env


class Reader:
    """Stands in for ``spark.read``: keeps the options, returns given frames."""

    def __init__(self, frames, log):
        self.frames, self.log, self.current = frames, log, {}

    def format(self, name):
        self.current = {"format": name}
        return self

    def options(self, **values):
        self.current |= values
        return self

    def option(self, key, value):
        self.current[key] = value
        return self

    def load(self):
        self.log.append(self.current)
        return self.frames["query" if "query" in self.current else "table"]

    def jdbc(self, url, table, predicates=None, properties=None):
        self.log.append({"url": url, "table": table, "predicates": predicates, **properties})
        return self.frames["table"]


class Session:
    def __init__(self, **frames):
        self.log = []
        self.frames = frames

    @property
    def read(self):
        return Reader(self.frames, self.log)


@pytest.fixture
def connection():
    return Connection("c", "jdbc:x://h", "x.Driver", "u", "secret")


@pytest.mark.parametrize("kind,env,url,driver", [
    ("oracle", {"DB_HOST": "h", "DB_SERVICE_NAME": "s"}, "jdbc:oracle:thin:@//h:1521/s", "oracle.jdbc.OracleDriver"),
    ("mysql", {"DB_HOST": "h"}, "jdbc:mysql://h:3306/sales", "com.mysql.cj.jdbc.Driver"),
    ("postgresql", {"DB_HOST": "h", "DB_PORT": "6", "DB_DB": "d"}, "jdbc:postgresql://h:6/d", "org.postgresql.Driver"),
    ("mssql", {"DB_HOST": "h", "DB_DATABASE": "d"}, "jdbc:sqlserver://h:1433;databaseName=d",
     "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    ("postgres", {"DB_JDBC_URL": "jdbc:own"}, "jdbc:own", "org.postgresql.Driver"),
])
def test_connections(kind, env, url, driver):
    found = connection_from_env("db", kind, "sales", env | {"DB_USERNAME": "u", "DB_PASSWORD": "secret"})
    assert (found.url, found.driver) == (url, driver)
    assert "secret" not in repr(found) and found.options()["password"] == "secret"


@pytest.mark.parametrize("kind,env", [
    ("oracle", {"DB_HOST": "h", "DB_USERNAME": "u", "DB_PASSWORD": "p"}),
    ("mysql", {"DB_JDBC_URL": "x", "DB_PASSWORD": "p"}), ("mysql", {"DB_JDBC_URL": "x", "DB_USERNAME": "u"}), ("mysql", {}),
])
def test_incomplete_connections(kind, env):
    with pytest.raises(jdbc.ConnectionSettingsError):
        connection_from_env("db", kind, "", env)
    with pytest.raises(ValueError):
        jdbc.dialect("db2")


def test_full_scan(spark, connection, orders):
    session = Session(table=orders)
    out = jdbc.scan(session, connection, jdbc.table_name("BANK", "ORDERS"), columns=["O_ORDERKEY"])
    assert out.columns == ["o_orderkey"]
    assert session.log == [{"format": "jdbc", "url": "jdbc:x://h", "driver": "x.Driver", "user": "u", "password": "secret",
                            "fetchsize": "10000", "dbtable": "BANK.ORDERS"}]


def test_split_with_given_bounds(spark, connection, orders):
    session = Session(table=orders)
    jdbc.scan(session, connection, "t", JdbcOptions("CUSTOMER_ID", "1", "10000000", 8))
    chosen = {k: session.log[0][k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")}
    assert chosen == {"partitionColumn": "CUSTOMER_ID", "lowerBound": "1", "upperBound": "10000000", "numPartitions": "8"}


def test_missing_bounds_are_asked_for(spark, connection, orders):
    bounds = spark.createDataFrame([(3, 99)], "lo int, hi int")
    session = Session(table=orders, query=bounds)
    jdbc.scan(session, connection, "t", JdbcOptions("k", None, "50", 4))
    assert session.log[0]["query"] == "SELECT MIN(k) AS lo, MAX(k) AS hi FROM t"
    assert (session.log[1]["lowerBound"], session.log[1]["upperBound"]) == ("3", "50")
    empty = Session(table=orders, query=spark.createDataFrame([(None, None)], "lo int, hi int"))
    jdbc.scan(empty, connection, "t", JdbcOptions("k"))
    assert "partitionColumn" not in empty.log[1]


@pytest.mark.parametrize("watermark,url,sql", [
    (Watermark("u", "2024-01-01 00:00:00"), "jdbc:oracle:x", "u > TIMESTAMP '2024-01-01 00:00:00'"),
    (Watermark("u", "2024-01-01 00:00:00"), "jdbc:sqlserver://x", "u > '2024-01-01 00:00:00'"),
    (Watermark("u", "2024-01-01", "date"), "jdbc:mysql://x", "u > DATE '2024-01-01'"),
    (Watermark("u", "17", "numeric"), "jdbc:mysql://x", "u > 17"),
    (Watermark("u", "x' OR '1'='1"), "jdbc:mysql://x", "u > TIMESTAMP 'x'' OR ''1''=''1'"),
    (Watermark("u", None), "jdbc:mysql://x", None),
])
def test_bounds_of_an_incremental_scan_are_those_of_the_new_rows(spark, connection, orders, watermark, url, sql):
    assert jdbc.newer_sql(watermark, url) == sql
    if url.startswith("jdbc:oracle"):
        session = Session(table=orders.withColumnRenamed("o_orderdate", "u"), query=spark.createDataFrame([(3, 99)], "lo int, hi int"))
        jdbc.scan(session, Connection("c", url, "d"), "t", JdbcOptions("k"), watermark=watermark)
        assert session.log[0]["query"] == f"SELECT MIN(k) AS lo, MAX(k) AS hi FROM t WHERE {sql}"


def test_predicates_replace_the_split_column(spark, connection, orders):
    session = Session(table=orders)
    jdbc.scan(session, connection, "t", predicates=["k % 2 = 0", "k % 2 = 1"])
    assert session.log[0]["predicates"] == ["k % 2 = 0", "k % 2 = 1"] and session.log[0]["user"] == "u"


def test_watermark_filters_before_projection(spark, connection, orders):
    out = jdbc.scan(Session(table=orders), connection, "t", columns=["o_orderkey"],
                    watermark=Watermark("O_ORDERDATE", "2000-01-01 00:00:00"))
    assert out.columns == ["o_orderkey"]
    assert out.count() == orders.where("o_orderdate > timestamp_ntz'2000-01-01'").count()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in out._jdf.queryExecution().executedPlan().toString()
