"""Registered queries: each runs the library's operators over whole tables.

Queries about writing build their tables in a fresh database below the session's
shared folder (``spark.checkpoint.dir``) and return what is read back. The SQL of
``oracle_sql`` says what the result must be.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import LoadSpec, run_load
from tidemark.functions.partitioning import PartitionRule
from tidemark.functions.names import identifier, unique
from tidemark.operators import dedup, ledger, maintenance as upkeep, merge, quality, transform, watermark
from tidemark.sinks import maintenance
from tidemark.sinks.ledgers import WatermarkStore
from tidemark.sinks.places import fresh_folder
from tidemark.sinks.tables import ParquetTable
from tidemark.sources import feeds, markers, tables
from tidemark.streaming import feeds as streams

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

AS_OF = dt.datetime(2024, 1, 1)
DAY = dt.date(2024, 1, 15)


def query(sql: str | None = None):
    """Register a function under its name, with the SQL of its result."""

    def register(function: Query) -> Query:
        _QUERIES[function.__name__] = function
        if sql:
            _SQL[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _database(spark: SparkSession) -> str:
    name = unique("tm").replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_folder(spark, name)}'")
    return name


def _target(spark: SparkSession, kind: str | None = None, column: str | None = None) -> ParquetTable:
    return ParquetTable(spark, _database(spark), "target", PartitionRule.parse(kind, column))


def _filled(spark: SparkSession, df: DataFrame, kind: str | None = None, column: str | None = None) -> ParquetTable:
    target = _target(spark, kind, column)
    target.publish_new(target.stage(df))
    return target


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _price(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))


def _run_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as a run ledger: a user is a job, an error a failed run."""
    return _table(spark, folder, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("user_id").alias("job_id"),
        F.col("ts").alias("start_time"),
        F.when(F.col("event_type") == "error", ledger.FAILED).otherwise(ledger.SUCCESS).alias("status"),
        F.col("value").alias("duration_seconds"),
        "event_type",
    )


def _spec(database: str, load: dict, **sections) -> LoadSpec:
    return LoadSpec.from_dict({
        "task": {"task_id": "job", "task_name": "job"},
        "source": {"type": "table", "connection": "none", "schema": "none", "table": "none"},
        "load": load,
        "target": {"type": "parquet", "catalog": "spark_catalog", "database": database, "table": "target",
                   **sections.pop("target", {})},
        "audit_columns": {"enabled": False},
        "preload": {"enabled": False},
        "postload": {"enabled": False},
        **sections,
    })


# --- scans ----------------------------------------------------------------

@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def scan_project(spark, folder):
    return transform.project(_table(spark, folder, "orders"), ["O_ORDERKEY", "o_custkey", "o_orderdate"])


@query("SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00'")
def scan_incremental(spark, folder):
    return watermark.newer_than(_table(spark, folder, "orders"), "o_orderdate", "2000-01-01 00:00:00")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00'")
def scan_incremental_partitioned(spark, folder):
    """The same scan of a table partitioned by month: older months are not opened."""
    t = _filled(spark, _table(spark, folder, "orders"), "months", "o_orderdate")
    return tables.scan(spark, t.name, ["o_orderkey", "o_orderdate"], watermark.Watermark("o_orderdate", "2000-01-01 00:00:00"), t.partition)


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15 10:00:00'")
def scan_incremental_days(spark, folder):
    """A table by days: only the watermark's day and later ones are opened."""
    t = _filled(spark, _table(spark, folder, "events"), "days", "ts")
    return tables.scan(spark, t.name, ["event_id", "ts"], watermark.Watermark("ts", "2024-01-15 10:00:00"), t.partition)


# --- feeds ----------------------------------------------------------------

def _csv_feed(spark, folder) -> str:
    """Orders as CSV files in two layouts: finished orders without priorities."""
    orders, path = _table(spark, folder, "orders"), fresh_folder(spark, "feed")
    finished = F.col("o_orderstatus") == "F"
    orders.where(finished).select("o_orderkey", "o_orderstatus").write.option("header", True).csv(f"{path}/finished")
    orders.where(~finished).select("o_orderpriority", "o_orderkey", "o_orderstatus").write.option("header", True).csv(f"{path}/open")
    return path


def _csv_rows(spark, folder, schema=None) -> DataFrame:
    listing = feeds.list_files(spark, _csv_feed(spark, folder), "*.csv")
    return feeds.csv_scan(spark, [r["file_path"] for r in listing.select("file_path").collect()], schema=schema)


_FEED_SQL = """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders"""


@query(_FEED_SQL)
def feed_csv_union(spark, folder):
    """Declared columns."""
    rows = _csv_rows(spark, folder, "o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING")
    return feeds.without_extras(rows)


@query(_FEED_SQL)
def feed_csv_inferred(spark, folder):
    rows = feeds.without_extras(_csv_rows(spark, folder))
    return rows.select(F.col("o_orderkey").cast("bigint"), "o_orderstatus", "o_orderpriority")


@query("""
SELECT CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'open' END AS feed, CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS corrupt
FROM orders GROUP BY 1""")
def feed_file_counts(spark, folder):
    rows, stored = _csv_rows(spark, folder, "o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING"), fresh_folder(spark, "rows")
    rows.write.parquet(stored)
    counts = feeds.file_counts(spark.read.parquet(stored))
    feed = F.element_at(F.split("file_path", "/"), -2).alias("feed")
    return counts.groupBy(feed).agg(F.sum("record_count").alias("n"), F.sum("corrupt_count").alias("corrupt"))


@query("SELECT DISTINCT o_orderpriority AS feed, true AS has_bytes, true AS is_dated FROM orders")
def feed_listing(spark, folder):
    path = fresh_folder(spark, "feed")
    _table(spark, folder, "orders").withColumn("feed", F.col("o_orderpriority")).write.partitionBy("feed").parquet(path)
    files = feeds.list_files(spark, path, "*.parquet")
    name = F.regexp_extract("file_path", "feed=([^/]+)/", 1).alias("feed")
    return files.groupBy(name).agg(
        F.bool_and(F.col("file_size") > 0).alias("has_bytes"), F.bool_and(F.col("last_modified").isNotNull()).alias("is_dated")
    )


@query("""
WITH cur AS (SELECT user_id, CAST(count(*) AS BIGINT) AS sz FROM events GROUP BY 1),
led AS (SELECT user_id, CAST(count(*) AS BIGINT) AS sz FROM events WHERE ts < TIMESTAMP '2024-01-30 12:00:00' GROUP BY 1)
SELECT cur.* FROM cur WHERE NOT EXISTS (SELECT 1 FROM led WHERE led.user_id = cur.user_id AND led.sz = cur.sz)""")
def feed_new_files(spark, folder):
    """Users as files, their event counts as fingerprints; the ledger is older."""
    events = _table(spark, folder, "events")
    listing = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("sz"))
    loaded = events.where(F.col("ts") < _ts("2024-01-30 12:00:00")).groupBy("user_id").agg(F.count(F.lit(1)).alias("sz"))
    return feeds.new_files(listing, loaded, ("user_id", "sz"))


@query("""
SELECT c_custkey FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-07-01')""")
def feed_missing(spark, folder):
    """Customers expected to order in the last month that did not."""
    arrived = _table(spark, folder, "orders").where(F.col("o_orderdate") >= _ts("2001-07-01"))
    return ledger.missing_keys(_table(spark, folder, "customer").select("c_custkey"), arrived, "c_custkey", "o_custkey")


@query("""
SELECT f.feed, f.pattern FROM (VALUES ('urgent', '1-*'), ('any', '*'), ('sixth', '6-*'), ('none', 'x?y')) AS f(feed, pattern)
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE
  (f.feed = 'urgent' AND o_orderpriority LIKE '1-%') OR (f.feed = 'any') OR
  (f.feed = 'sixth' AND o_orderpriority LIKE '6-%') OR (f.feed = 'none' AND o_orderpriority LIKE 'x_y'))""")
def feed_missing_patterns(spark, folder):
    names = _table(spark, folder, "orders").select(F.col("o_orderpriority").alias("file_name"))
    return ledger.missing_feeds(names, [("urgent", "1-*"), ("any", "*"), ("sixth", "6-*"), ("none", "x?y")])


@query("""
SELECT 'day_' || strftime(CAST(ts AS DATE), '%Y-%m-%d') AS job_id,
       CASE WHEN count(*) FILTER (WHERE event_type = 'error') * 5 > count(*) THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CAST(count(*) AS BIGINT) AS rows_read, '/specs/' || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '.toml' AS config_path
FROM events GROUP BY CAST(ts AS DATE)""")
def marker_scan(spark, folder):
    """One marker file per day of events, written as text and scanned back."""
    day, path = F.date_format("ts", "yyyy-MM-dd"), fresh_folder(spark, "markers")
    failed = F.count_if(F.col("event_type") == "error") * 5 > F.count(F.lit(1))
    runs = _table(spark, folder, "events").groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"))
    text = F.concat_ws(
        "\n", F.concat(F.lit("JOB ID                 : day_"), "day"),
        F.concat(F.lit("CONFIG PATH            : /specs/"), "day", F.lit(".toml")),
        F.concat(F.lit("STATUS                 : "), "status"), F.concat(F.lit("ROWS READ              : "), "n"))
    runs.select("day", text.alias("value")).write.partitionBy("day").text(path)
    return markers.scan(spark, path).select("job_id", "status", "rows_read", "config_path")


# --- transforms -----------------------------------------------------------

@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def xform_exclude(spark, folder):
    return transform.exclude(_table(spark, folder, "customer"), ["C_NAME", "no_such_column"], ["c_acctbal"])


@query("SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer")
def xform_rename(spark, folder):
    names = {"C_CUSTKEY": "customer_id", "c_name": "customer_name", "C_AcctBal": "balance", "gone": "x"}
    return transform.rename(_table(spark, folder, "customer"), names)


@query("""
SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, TRY_CAST(c_mktsegment AS INTEGER) AS segment_number FROM customer""")
def xform_cast(spark, folder):
    renames = {"c_mktsegment": "segment_number"}
    df = transform.rename(_table(spark, folder, "customer"), renames)
    df = transform.cast(df, {"C_ACCTBAL": "DECIMAL(18,2)", "c_mktsegment": "INT", "gone": "INT", "c_name": "NOTYPE"}, renames)
    return df.select("c_custkey", "c_acctbal", "segment_number")


@query("""
SELECT event_id, upper(event_type) AS etype, regexp_replace(event_type, '[aeiou]', '_', 'g') AS masked,
  CAST(date_trunc('day', ts) AS DATE) AS d, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS age,
  CAST(event_id % 7 AS BIGINT) AS m, CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS v,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  coalesce(nullif(event_type, 'view'), 'none') AS nz, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS k_next,
  CAST(len(string_split(event_type, 'i')) AS INTEGER) AS pieces, event_type AS from_map
FROM events""")
def xform_derive(spark, folder):
    """One expression of every function family; later ones use earlier ones."""
    df = transform.derive(_table(spark, folder, "events"), {
        "etype": "upper(event_type)",
        "masked": "regexp_replace(event_type, '[aeiou]', '_')",
        "d": "to_date(date_trunc('day', ts))",
        "age": "datediff(d, DATE'2024-01-01')",
        "m": "event_id % 7",
        "v": "CAST(value AS DECIMAL(18,2))",
        "status": "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END",
        "nz": "coalesce(nullif(event_type, 'view'), 'none')",
        "k": "CAST(get_json_object(props, '$.k') AS INT)",
        "k_next": "k + 1",
        "pieces": "size(split(event_type, 'i'))",
        "from_map": "str_to_map(concat('t=', event_type), ',', '=')['t']",
    })
    return transform.exclude(df, ["ts", "user_id", "event_type", "value", "props"])


@query("""
SELECT c_custkey, TIMESTAMP '2024-01-01 06:00:00' AS dwh_insert_ts, TIMESTAMP '2024-01-01 06:00:00' AS dwh_updated_ts,
       'run_1' AS dwh_etl_run_id, 'tester' AS dwh_job_user FROM customer""")
def xform_audit(spark, folder):
    df = transform.audit(_table(spark, folder, "customer").select("c_custkey"), run_id="run_1", job_user="tester", as_of=AS_OF)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("dwh_insert_ts", "dwh_updated_ts")})


_CUSTOMER_TRANSFORM = {
    "exclude": ["c_nationkey", "c_mktsegment"],
    "rename": {"C_CUSTKEY": "customer_id", "C_NAME": "customer_name", "C_ACCTBAL": "balance"},
    "cast": {"C_CUSTKEY": "BIGINT", "C_ACCTBAL": "DECIMAL(18,2)"},
    "derived": {"source_system": "'ORACLE'", "name_uc": "upper(customer_name)"},
}


@query("""
SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
       'ORACLE' AS source_system, upper(c_name) AS name_uc FROM customer""")
def xform_all(spark, folder):
    rules = transform.TransformRules(**_CUSTOMER_TRANSFORM)
    return transform.transform(_table(spark, folder, "customer"), rules)


# --- quality --------------------------------------------------------------

@query("SELECT 'minimum_rows' AS rule, CAST(count(*) AS BIGINT) AS total_rows, count(*) >= 1 AS passed FROM orders")
def dq_min_rows(spark, folder):
    return quality.row_count(_table(spark, folder, "orders"), 1)


def _holed(spark, folder) -> DataFrame:
    return _table(spark, folder, "events").select(
        "event_id", F.expr("nullif(event_type, 'error')").alias("a"), F.expr("nullif(event_type, 'view')").alias("b"))


@query("SELECT CAST(count(*) AS BIGINT) AS violations FROM events WHERE event_type IN ('error', 'view')")
def dq_nulls(spark, folder):
    return quality.null_count(_holed(spark, folder), ["a", "b"])


@query("SELECT event_id, nullif(event_type, 'error') AS a, nullif(event_type, 'view') AS b FROM events WHERE event_type IN ('error', 'view')")
def dq_null_rows(spark, folder):
    return quality.null_rows(_holed(spark, folder), ["a", "b"])


@query("""
SELECT CAST(count(*) AS BIGINT) AS dup_groups
FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def dq_unique(spark, folder):
    return quality.duplicate_count(_table(spark, folder, "lineitem"), ["L_ORDERKEY", "l_linenumber"])


@query("""
SELECT CAST(count(*) AS BIGINT) AS dup_groups
FROM (SELECT nullif(event_type, 'error') AS k FROM events GROUP BY 1 HAVING count(*) > 1)""")
def dq_unique_null_keys(spark, folder):
    return quality.duplicate_count(_holed(spark, folder), ["a"])


@query("""
SELECT 'minimum_rows' AS rule, CAST(count(*) AS BIGINT) AS violations, count(*) >= 1 AS passed FROM lineitem
UNION ALL SELECT 'null_check', CAST(count(*) FILTER (WHERE l_orderkey IS NULL OR l_shipdate IS NULL) AS BIGINT),
  count(*) FILTER (WHERE l_orderkey IS NULL OR l_shipdate IS NULL) = 0 FROM lineitem
UNION ALL SELECT 'unique_check', CAST(count(*) AS BIGINT), count(*) = 0
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def dq_report(spark, folder):
    rules = quality.QualityRules(null_check=("l_orderkey", "l_shipdate"), minimum_rows=1)
    return quality.report(_table(spark, folder, "lineitem"), rules, ["l_orderkey", "l_linenumber"])


@query("""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey FROM lineitem l
JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) d
  ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber""")
def dq_violating_rows(spark, folder):
    rows = _table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return quality.duplicate_rows(rows, ["l_orderkey", "l_linenumber"])


# --- watermarks and incremental loads -------------------------------------

@query("SELECT max(o_orderdate) AS max_wm FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'")
def wm_batch_max(spark, folder):
    batch = watermark.newer_than(_table(spark, folder, "orders"), "o_orderdate", "2000-01-01 00:00:00")
    return watermark.batch_high(batch, "O_ORDERDATE")


@query("SELECT user_id AS job_id, arg_max(event_id, ts) AS watermark_value, max(ts) AS updated_at FROM events GROUP BY 1")
def wm_latest_per_job(spark, folder):
    history = _table(spark, folder, "events").select(
        F.col("user_id").alias("job_id"), F.col("event_id").alias("watermark_value"), F.col("ts").alias("updated_at"))
    return watermark.latest_per_job(history)


def _incremental(spark, folder, database, cuts) -> None:
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    load = {"type": "incremental", "incremental": {"column": "O_ORDERDATE"}, "options": {"initial_watermark": "1996-01-01 00:00:00"}}
    spec = _spec(database, load, target={"partition": {"type": "years", "column": "o_orderdate"}})
    for cut in cuts:
        source = orders.where(F.col("o_orderdate") < _ts(cut)) if cut else orders
        run_load(spark, spec, batch=source, state_database=database, force=True)


@query("SELECT 'job' AS job_id, max(o_orderdate) AS watermark_value, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01'")
def wm_empty_batch(spark, folder):
    """A second load finds nothing new: rows and watermark stay as they were."""
    database = _database(spark)
    _incremental(spark, folder, database, [None, None])
    n = ParquetTable(spark, database, "target").read().count()
    current = WatermarkStore(spark, database).current()
    return current.select("job_id", F.col("watermark_value").cast("timestamp_ntz").alias("watermark_value"), F.lit(n).cast("bigint").alias("n"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01'")
def incr_slices_equal_full(spark, folder):
    """Three incremental loads add up to one."""
    database = _database(spark)
    _incremental(spark, folder, database, ["1998-04-05 00:00:00", "2000-06-07 00:00:00", None])
    return ParquetTable(spark, database, "target").read()


# --- table writes ---------------------------------------------------------

@query("SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'")
def sink_full_replace(spark, folder):
    orders = _table(spark, folder, "orders")
    target = _filled(spark, orders, "years", "o_orderdate")
    target.publish_replace(target.stage(orders.where(F.col("o_orderdate") >= _ts("2001-01-01"))))
    return target.read()


@query("SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def sink_append(spark, folder):
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    target = _filled(spark, orders)
    target.publish_append(target.stage(orders.where("o_orderstatus = 'F'")))
    return target.read()


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders
WHERE NOT (year(o_orderdate) = 2000 AND o_orderstatus <> 'F')""")
def sink_overwrite_partitions(spark, folder):
    """The batch holds only finished orders of 2000; the other years stay."""
    orders = _table(spark, folder, "orders")
    target = _filled(spark, orders, "years", "o_orderdate")
    target.publish_partitions(target.stage(orders.where("year(o_orderdate) = 2000 AND o_orderstatus = 'F'")))
    return target.read().select("o_orderkey", F.year("o_orderdate").alias("y"))


@query("""
SELECT CAST(count(DISTINCT CAST(ts AS DATE)) AS BIGINT) AS days, CAST(count(DISTINCT date_trunc('hour', ts)) AS BIGINT) AS hours,
       CAST(count(DISTINCT date_trunc('month', ts)) AS BIGINT) AS months, CAST(count(DISTINCT year(ts)) AS BIGINT) AS years FROM events""")
def sink_partition_values(spark, folder):
    events = _table(spark, folder, "events")
    kinds = {k: PartitionRule.parse(k, "ts").value(F.col("ts")) for k in ("days", "hours", "months", "years")}
    # Distinct hours first: the other three follow from them.
    return events.select(*[v.alias(k) for k, v in kinds.items()]).distinct().agg(
        *[F.count_distinct(k).alias(k) for k in kinds])


_BUCKETS = 16


@query("""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS part, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1
UNION ALL SELECT strftime(ts, '%Y-%m-%d-%H'), CAST(count(*) AS BIGINT) FROM events GROUP BY 1""")
def sink_days_hours_partitions(spark, folder):
    """Events written by days and by hours, read back by partition value."""
    events = _table(spark, folder, "events")
    parts = [spark.table(_filled(spark, events, kind, "ts").name).groupBy(F.col(name).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("n"))
             for kind, name in (("days", "ts_day"), ("hours", "ts_hour"))]
    return parts[0].unionByName(parts[1])


@query("SELECT o_custkey, CAST(count(*) AS BIGINT) AS n, CAST(1 AS BIGINT) AS buckets FROM orders GROUP BY 1")
def sink_bucket_partitions(spark, folder):
    """Bucket partitioning: all rows of a key are in one partition."""
    target = _filled(spark, _table(spark, folder, "orders"), f"bucket({_BUCKETS})", "o_custkey")
    stored = spark.table(target.name).groupBy("o_custkey", "o_custkey_bucket").agg(F.count(F.lit(1)).alias("n"))
    return stored.groupBy("o_custkey").agg(F.sum("n").alias("n"), F.count("o_custkey_bucket").alias("buckets"))


# --- merges ---------------------------------------------------------------

_MERGE_SQL = """
WITH s AS (SELECT o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 10 AS DECIMAL(18,2)) AS price
           FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01'),
t AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price
      FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)"""


def _merge_sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    orders = _table(spark, folder, "orders")
    raised = (F.col("price") + 10).cast("decimal(18,2)")
    return (_price(orders.where(F.col("o_orderdate") < _ts("2000-01-01"))),
            _price(orders.where(F.col("o_orderdate") >= _ts("1999-07-01"))).withColumn("price", raised))


@query(_MERGE_SQL)
def merge_upsert(spark, folder):
    """The pure operator."""
    return merge.upsert(*_merge_sides(spark, folder), ["O_ORDERKEY"])


@query(_MERGE_SQL)
def merge_table(spark, folder):
    """The same as a table write."""
    old, new = _merge_sides(spark, folder)
    target = _filled(spark, old)
    target.merge(new, ["o_orderkey"])
    return target.read()


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN TIMESTAMP '1999-12-31' ELSE o_orderdate END AS o_orderdate
FROM orders""")
def merge_moves_partitions(spark, folder):
    """Matched rows change their partition; emptied partitions disappear."""
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    target = _filled(spark, orders, "years", "o_orderdate")
    late = orders.where(F.col("o_orderdate") >= _ts("2000-01-01")).withColumn("o_orderdate", _ts("1999-12-31"))
    target.merge(late, ["o_orderkey"])
    return target.read()


@query("""
WITH b AS (SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-30' GROUP BY 1, 2),
t AS (SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n FROM events WHERE ts < TIMESTAMP '2024-01-30' GROUP BY 1, 2)
SELECT * FROM b UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = t.user_id AND b.event_type = t.event_type)""")
def merge_composite(spark, folder):
    events, last = _table(spark, folder, "events"), F.col("ts") >= _ts("2024-01-30")
    counted = lambda df: df.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    target = _filled(spark, counted(events.where(~last)), None, "event_type")
    target.merge(counted(events.where(last)), ["user_id", "event_type"])
    return target.read()


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'run_1' ELSE 'run_2' END AS insert_run,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-07-01' THEN 'run_2' ELSE 'run_1' END AS update_run FROM orders""")
def merge_preserve_insert_ts(spark, folder):
    orders = _table(spark, folder, "orders")
    stamped = lambda df, run: df.select("o_orderkey", F.lit(run).alias("insert_run"), F.lit(run).alias("update_run"))
    target = _filled(spark, stamped(orders.where(F.col("o_orderdate") < _ts("2000-01-01")), "run_1"))
    target.merge(stamped(orders.where(F.col("o_orderdate") >= _ts("1999-07-01")), "run_2"), ["o_orderkey"], preserve=["insert_run"])
    return target.read()


_LATEST_SQL = """
SELECT user_id, event_id, event_type, ts
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


@query(_LATEST_SQL)
def dedup_latest(spark, folder):
    events = _table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    return dedup.latest(events, ["user_id"], ["ts", "event_id"])


# --- schema evolution -----------------------------------------------------

@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def schema_evolve(spark, folder):
    """The second batch brings a new column."""
    orders = _table(spark, folder, "orders")
    target = _filled(spark, orders.where(F.col("o_orderdate") < _ts("1998-01-01")).select("o_orderkey"))
    more = orders.where(F.col("o_orderdate") >= _ts("1998-01-01")).select("o_orderkey", "o_orderpriority")
    target.reconcile(more.schema)
    target.append(more)
    return target.read()


@query("""
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price, CASE WHEN o_orderstatus = 'F' THEN 'x' END AS note FROM orders""")
def schema_widen(spark, folder):
    """A batch with narrower types and a new column: widened, column added."""
    orders = _table(spark, folder, "orders")
    price = lambda kind: F.col("o_totalprice").cast(kind).alias("price")
    target = _filled(spark, orders.where("o_orderstatus <> 'F'").select("o_orderkey", price("decimal(18,2)")))
    narrow = orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").cast("int").alias("O_OrderKey"), price("decimal(12,2)"), F.lit("x").alias("note"))
    target.reconcile(narrow.schema)
    target.append(narrow)
    return target.read()


@query("""
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM orders GROUP BY 1""")
def gold_aggregate(spark, folder):
    """Orders and revenue per status, by a load whose spec aggregates."""
    database = _database(spark)
    spec = _spec(
        database, {"type": "full"}, transform={"cast": {"o_totalprice": "DECIMAL(18,2)"}, "rename": {"o_totalprice": "price"}},
        aggregate={"keys": ["O_ORDERSTATUS"], "columns": {"n": "count(*)", "total": "CAST(sum(price) AS DECIMAL(28,2))"}},
    )
    run_load(spark, spec, batch=_table(spark, folder, "orders"), state_database=database)
    return ParquetTable(spark, database, "target").read()


# --- maintenance ----------------------------------------------------------

def _fragmented(spark, folder) -> ParquetTable:
    target = _target(spark, "years", "o_orderdate")
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    target.publish_new(target.stage(orders.repartition(12, "o_orderkey"), rebalance=False))
    return target


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def compact_preserves_rows(spark, folder):
    target = _fragmented(spark, folder)
    maintenance.compact(target)
    return target.read()


@query("""
SELECT CAST(year(o_orderdate) AS VARCHAR) AS "partition", true AS fragmented, CAST(1 AS BIGINT) AS files_after, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1""")
def compaction_plan(spark, folder):
    """Per partition: whether the plan rewrites it, and what is there afterwards."""
    target = _fragmented(spark, folder)
    before = upkeep.compaction_plan(maintenance.table_files(target)).select("partition", F.col("rewrite").alias("fragmented"))
    kept = fresh_folder(spark, "plan")
    before.write.parquet(kept)  # the table is about to change
    maintenance.compact(target)
    after = maintenance.table_files(target).groupBy("partition").agg(F.count(F.lit(1)).alias("files_after"))
    rows = spark.table(target.name).groupBy(F.col("o_orderdate_year").cast("string").alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    return spark.read.parquet(kept).join(after, "partition").join(rows, "partition")


@query("SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders WHERE o_orderstatus = 'F'")
def orphan_candidates(spark, folder):
    """Partitions whose replaced files nobody reads any more."""
    orders = _table(spark, folder, "orders")
    target = _filled(spark, orders, "years", "o_orderdate")
    target.publish_partitions(target.stage(orders.where("o_orderstatus = 'F'")))
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(days=4)
    orphans = maintenance.find_orphans(target, older_than_days=3, now=later)
    return orphans.select(F.regexp_extract("file_path", "o_orderdate_year=([0-9]+)/", 1).alias("y")).distinct()


# --- ledger ---------------------------------------------------------------

@query("""
SELECT user_id AS job_id, CAST(count(*) AS BIGINT) AS failures, min(ts) AS first_ts, max(ts) AS last_ts
FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY 1""")
def ledger_failed_dedup(spark, folder):
    return ledger.failed_jobs(_run_ledger(spark, folder), DAY)


@query("""
SELECT user_id AS job_id, CAST(count(*) AS BIGINT) AS successes, min(ts) AS first_ts, max(ts) AS last_ts
FROM events WHERE event_type <> 'error' AND CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY 1""")
def ledger_succeeded(spark, folder):
    return ledger.succeeded_jobs(_run_ledger(spark, folder), DAY)


@query("SELECT event_id AS run_id, user_id AS job_id, ts AS start_time FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-15'")
def ledger_failed_runs(spark, folder):
    return ledger.failed_runs(_run_ledger(spark, folder), DAY).select("run_id", "job_id", "start_time")


@query("""
SELECT DISTINCT user_id AS job_id FROM events e WHERE NOT EXISTS (
  SELECT 1 FROM events s WHERE s.user_id = e.user_id AND s.event_type <> 'error' AND CAST(s.ts AS DATE) = DATE '2024-01-15')""")
def ledger_skip_succeeded(spark, folder):
    runs = _run_ledger(spark, folder)
    return ledger.jobs_to_run(runs, runs, DAY)


@query("""
SELECT DISTINCT f.user_id AS job_id FROM events f WHERE f.event_type = 'error' AND CAST(f.ts AS DATE) = DATE '2024-01-15' AND NOT EXISTS (
  SELECT 1 FROM events s WHERE s.user_id = f.user_id AND s.event_type <> 'error' AND CAST(s.ts AS DATE) = DATE '2024-01-15' AND s.ts > f.ts)""")
def ledger_rerun_set(spark, folder):
    return ledger.unrecovered_jobs(_run_ledger(spark, folder), DAY)


@query("""
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS succeeded,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS failed, CAST(count(DISTINCT user_id) AS BIGINT) AS jobs FROM events""")
def ledger_summary(spark, folder):
    return ledger.summary(_run_ledger(spark, folder))


@query("""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM customer) AS configured,
  (SELECT CAST(count(*) AS BIGINT) FROM customer WHERE c_mktsegment <> 'BUILDING') AS enabled,
  (SELECT CAST(count(*) AS BIGINT) FROM events WHERE event_type <> 'error' AND CAST(ts AS DATE) = DATE '2024-01-15') AS successes,
  (SELECT CAST(count(*) AS BIGINT) FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-15') AS failures""")
def ledger_kpis(spark, folder):
    tasks = _table(spark, folder, "customer").select((F.col("c_mktsegment") != "BUILDING").alias("enabled"))
    return ledger.kpis(tasks, _run_ledger(spark, folder), DAY)


@query("SELECT event_id, user_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")
def ledger_recent(spark, folder):
    return ledger.recent(_table(spark, folder, "events").select("event_id", "user_id", "ts"), ["ts", "event_id"])


@query("""
SELECT p_partkey, p_name, p_brand FROM part WHERE p_size = 10 AND (contains(lower(p_name), 'a') OR contains(lower(p_brand), 'a'))""")
def catalog_search(spark, folder):
    hits = ledger.search(_table(spark, folder, "part"), {"p_size": 10}, " A ", ["p_name", "p_brand"])
    return hits.select("p_partkey", "p_name", "p_brand")


@query("SELECT DISTINCT p_brand FROM part WHERE p_brand <> 'N/A'")
def catalog_facets(spark, folder):
    return ledger.facets(_table(spark, folder, "part"), "p_brand")


@query("""
SELECT 'customer' AS tbl, CAST(count(*) AS BIGINT) AS n FROM customer UNION ALL
SELECT 'orders', CAST(count(*) AS BIGINT) FROM orders UNION ALL SELECT 'lineitem', CAST(count(*) AS BIGINT) FROM lineitem""")
def verify_counts(spark, folder):
    return ledger.table_counts({n: _table(spark, folder, n) for n in ("customer", "orders", "lineitem")})


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN 'on_failure' WHEN 'purchase' THEN 'on_success' ELSE event_type END AS event,
       CASE event_type WHEN 'error' THEN 'on_failure' WHEN 'purchase' THEN 'on_success' ELSE 'default' END AS rule FROM events""")
def event_routing(spark, folder):
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "purchase", "success").otherwise(F.col("event_type"))
    rules = [ledger.RoutingRule("on_failure", enabled=False), ledger.RoutingRule("on_failure", ("a@b.c",)), ledger.RoutingRule("on_success")]
    runs = _table(spark, folder, "events").select("event_id", status.alias("status"))
    return ledger.route(runs, rules, ["ops@b.c"]).drop("status")


@query("SELECT p_name AS task_id, p_brand AS depends_on FROM part UNION ALL SELECT p_name, p_type FROM part")
def task_edges(spark, folder):
    part = _table(spark, folder, "part")
    return ledger.task_edges(part.select(F.col("p_name").alias("task_id"), F.array("p_brand", "p_type").alias("depends_on")))


@query("""
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')""")
def dep_missing(spark, folder):
    """Orders whose customer is absent from a reduced customer table."""
    kept = _table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'")
    return ledger.without_parent(_table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_custkey", kept, "c_custkey")


@query("SELECT event_id AS run_id, user_id AS job_id, value AS duration_seconds FROM events WHERE value > 100")
def sla_breach(spark, folder):
    return ledger.sla_breaches(_run_ledger(spark, folder), 100).select("run_id", "job_id", "duration_seconds")


@query("""
SELECT event_id AS run_id, user_id AS job_id, value AS duration_seconds FROM events
JOIN (SELECT user_id, avg(value) AS mean FROM events GROUP BY 1) USING (user_id) WHERE value > 3 * mean""")
def sla_breach_per_job(spark, folder):
    """Runs that took more than three times their job's mean."""
    runs = _run_ledger(spark, folder)
    limits = runs.groupBy("job_id").agg((3 * F.avg("duration_seconds")).alias("limit_seconds"))
    return ledger.sla_breaches(runs, limits).select("run_id", "job_id", "duration_seconds")


@query("""
WITH c AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
k AS (SELECT event_type, CAST(unnest(generate_series(min(day), (SELECT max(day) FROM c), INTERVAL 1 DAY)) AS DATE) AS day FROM c GROUP BY 1),
d AS (SELECT event_type, day, coalesce(n, 0) AS n FROM k LEFT JOIN c USING (event_type, day)),
w AS (SELECT *, sum(n) OVER p AS s, count(*) OVER p AS c FROM d
      WINDOW p AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT event_type, day, CAST(n AS BIGINT) AS n FROM w WHERE c = 7 AND n * 700 < s * 97""")
def count_anomaly(spark, folder):
    """Days more than 3 % below the mean of the previous seven, per event type."""
    return ledger.drops(ledger.daily_counts(_table(spark, folder, "events"), "event_type", "ts"), "event_type", 3)


@query("""
WITH c AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
k AS (SELECT event_type, CAST(unnest(generate_series(min(day), (SELECT max(day) FROM c), INTERVAL 1 DAY)) AS DATE) AS day FROM c GROUP BY 1),
d AS (SELECT event_type, day, coalesce(n, 0) AS n FROM k LEFT JOIN c USING (event_type, day)),
w AS (SELECT *, avg(n) OVER p AS m, stddev_samp(n) OVER p AS s, count(*) OVER p AS c FROM d
      WINDOW p AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT event_type, day, CAST(n AS BIGINT) AS n FROM w WHERE c = 7 AND abs(n - m) > 1.5 * s""")
def count_outliers(spark, folder):
    return ledger.outliers(ledger.daily_counts(_table(spark, folder, "events"), "event_type", "ts"), "event_type", 1.5)


@query("""
WITH s AS (SELECT user_id, event_id // 40 AS run, ts AS moment,
    CASE event_type WHEN 'signup' THEN 'START' WHEN 'purchase' THEN 'END' ELSE 'BEAT' END AS signal FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00'),
r AS (SELECT user_id, run, coalesce(min(moment) FILTER (WHERE signal = 'START'), min(moment)) AS start_time,
    max(moment) FILTER (WHERE signal = 'START') AS again, max(moment) FILTER (WHERE signal = 'END') AS ended, max(moment) FILTER (WHERE signal = 'BEAT') AS beat FROM s GROUP BY 1, 2),
o AS (SELECT *, greatest(start_time, again, beat) AS last_seen FROM r WHERE ended IS NULL OR again > ended),
x AS (SELECT *, (epoch_us(TIMESTAMP '2024-01-20 12:00:00') - epoch_us(start_time)) / 1000000 > 86400 * (1 + user_id % 9) AS overdue,
    (epoch_us(TIMESTAMP '2024-01-20 12:00:00') - epoch_us(last_seen)) / 1000000 > 432000 AS silent FROM o)
SELECT user_id AS job_id, run AS run_id, start_time, last_seen,
    CASE WHEN overdue AND silent THEN 'OVERDUE,SILENT' WHEN overdue THEN 'OVERDUE' ELSE 'SILENT' END AS reason FROM x WHERE overdue OR silent""")
def ledger_open_runs(spark, folder):
    """Events read as signals (a signup starts a run, a purchase ends it, all else is a sign of
    life): runs open longer than their job's limit, and those silent for five days."""
    kind = F.when(F.col("event_type") == "signup", ledger.START).when(F.col("event_type") == "purchase", ledger.END).otherwise(ledger.BEAT)
    signals = _table(spark, folder, "events").select(
        F.col("user_id").alias("job_id"), F.floor(F.col("event_id") / 40).alias("run_id"), kind.alias("signal"), F.col("ts").alias("at"))
    limits = signals.select("job_id").distinct().withColumn("limit_seconds", 86400.0 * (1 + F.col("job_id") % 9))
    found = ledger.open_runs(signals, dt.datetime(2024, 1, 20, 12), limits, 5 * 86400)
    return found.select("job_id", "run_id", "start_time", "last_seen", "reason")


# --- streams --------------------------------------------------------------

def _event_files(spark, folder) -> tuple[DataFrame, str]:
    events, path = _table(spark, folder, "events"), fresh_folder(spark, "stream")
    events.repartition(4, "event_id").write.parquet(path)
    return events, path


@query("SELECT event_id, user_id, event_type, ts FROM events")
def stream_ingest(spark, folder):
    """All files, in several micro-batches, exactly once; a rerun adds nothing."""
    events, path = _event_files(spark, folder)
    out, checkpoint = fresh_folder(spark, "ingested"), fresh_folder(spark, "checkpoint")
    for _ in range(2):
        stream = streams.read(spark, path, events.schema, "parquet", files_per_batch=2)
        streams.ingest(stream.select("event_id", "user_id", "event_type", "ts"), out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


@query(_LATEST_SQL)
def stream_upsert(spark, folder):
    """Latest event per user, merged micro-batch by micro-batch."""
    events, path = _event_files(spark, folder)
    target = _target(spark)
    stream = streams.read(spark, path, events.schema, "parquet", files_per_batch=2).select("user_id", "event_id", "event_type", "ts")
    streams.upsert(stream, target, ["user_id"], ["ts", "event_id"], fresh_folder(spark, "checkpoint")).awaitTermination()
    return target.read()


@query("SELECT event_id, user_id, ts FROM events")
def stream_dedup(spark, folder):
    """Every event is delivered twice and kept once."""
    events, path = _event_files(spark, folder)
    events.repartition(3, "ts").write.mode("append").parquet(path)
    out = fresh_folder(spark, "ingested")
    stream = streams.read(spark, path, events.schema, "parquet").select("event_id", "user_id", "ts")
    unique_events = streams.without_repeats(stream, ["event_id"], "ts", "60 days")
    streams.ingest(unique_events, out, fresh_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out)


def _files_in_place(spark, rows: DataFrame, folder: str) -> None:
    """Write rows as CSV files of fixed names, over those that are there."""
    from tidemark.sinks.places import delete_path, move_path, paths_like

    fresh = fresh_folder(spark, "csv")
    rows.write.option("header", True).csv(fresh)
    for k, path in enumerate(sorted(paths_like(spark, f"{fresh}/part-*"))):
        delete_path(spark, f"{folder}-{k}.csv")
        move_path(spark, path, f"{folder}-{k}.csv")


@query("SELECT o_orderkey, o_orderstatus, CAST(1 AS BIGINT) AS copies FROM orders")
def stream_rewritten_files(spark, folder):
    """A stream of files of which some are rewritten in place between two triggers, and none
    before a third: the rows of a rewritten file replace those it had, once."""
    from tidemark.streaming import rewrites

    database, path, state = _database(spark), fresh_folder(spark, "feed"), fresh_folder(spark, "state")
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderstatus").repartition(3, "o_orderkey")
    opened = F.col("o_orderstatus") == "O"
    target = rewrites.target(spark, database, "target", buckets=4)
    _files_in_place(spark, orders.where(~opened), f"{path}/other")
    _files_in_place(spark, orders.where(opened).withColumn("o_orderstatus", F.lit("?")), f"{path}/open")
    for rewritten in (False, True, False):
        if rewritten:
            _files_in_place(spark, orders.where(opened), f"{path}/open")
        rewrites.ingest(spark, path, "o_orderkey BIGINT, o_orderstatus STRING", target, f"{state}/check", f"{state}/listings").awaitTermination()
    # Nearly every row is a group: dealt out first, a task holds those of its share, not of whole row groups.
    rows = target.read().repartition("o_orderkey", "o_orderstatus")
    return rows.groupBy("o_orderkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("copies"))


# --- whole loads ----------------------------------------------------------

@query("""
SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(c_acctbal AS DECIMAL(18,2)) AS balance, 'ORACLE' AS source_system,
       upper(c_name) AS name_uc, 'run_1' AS dwh_etl_run_id FROM customer""")
def load_customer_full(spark, folder):
    """A full load by spec: transforms, audit columns, gate, publish, hooks."""
    database = _database(spark)
    spec = _spec(
        database, {"type": "full"}, transform=_CUSTOMER_TRANSFORM, audit_columns={"enabled": True},
        data_quality={"null_check": ["C_CUSTKEY"], "unique_check": ["customer_id"], "minimum_rows": 1},
        preload={"operations": ["validate_source", "validate_target", "check_watermark"]},
        postload={"operations": ["update_watermark", "compact_table", "refresh_metadata"]},
    )
    run_load(spark, spec, batch=_table(spark, folder, "customer"), state_database=database, run_id="run_1", job_user="tester", as_of=AS_OF)
    loaded = ParquetTable(spark, database, "target").read()
    return transform.exclude(loaded, ["dwh_insert_ts", "dwh_updated_ts", "dwh_job_user"])


@query("""
SELECT o_orderkey AS order_id, o_orderstatus AS status, o_orderdate AS updated_at FROM orders""")
def load_orders_upsert(spark, folder):
    """Two upsert loads; every order first arrives open, then with its status. The
    merge key, the watermark and the partition column are renamed on the way."""
    database = _database(spark)
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    spec = _spec(
        database, {"type": "upsert", "incremental": {"column": "O_ORDERDATE"}}, keys={"merge_keys": ["O_ORDERKEY"]},
        transform={"rename": {"o_orderkey": "order_id", "o_orderstatus": "status", "o_orderdate": "updated_at"}},
        target={"partition": {"type": "years", "column": "updated_at"}},
    )
    early = orders.withColumns({"o_orderstatus": F.lit("new"), "o_orderdate": F.lit("1990-05-05").cast("timestamp_ntz")})
    run_load(spark, spec, batch=early, state_database=database, force=True)
    run_load(spark, spec, batch=orders, state_database=database, force=True)
    return ParquetTable(spark, database, "target").read()


@query("SELECT o_orderkey AS invoice_id, o_orderstatus AS status, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority FROM orders")
def load_csv_feed(spark, folder):
    """A full feed load by spec, run twice: the second replaces all rows by the same ones."""
    database, path = _database(spark), _csv_feed(spark, folder)
    spec = _spec(
        database, {"type": "full"},
        source={"type": "sftp", "connection": "feed", "schema": "feed", "table": "orders", "path": path, "file_pattern": "*.csv",
                "columns_ddl": "o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING"},
        transform={"rename": {"O_ORDERKEY": "invoice_id", "O_ORDERSTATUS": "status", "O_ORDERPRIORITY": "priority"}},
    )
    for _ in range(2):
        run_load(spark, spec, state_database=database, force=True)
    return ParquetTable(spark, database, "target").read()


@query("SELECT o_orderkey, o_orderstatus, CAST(2 AS BIGINT) AS layouts FROM orders")
def load_feed_new_file(spark, folder):
    """A full load of a feed in which a second file arrives: all rows are there afterwards,
    in an unpartitioned table and in one by status."""
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    loaded = []
    for partition in ({}, {"type": "identity", "column": "o_orderstatus"}):
        database, path = _database(spark), fresh_folder(spark, "feed")
        spec = _spec(
            database, {"type": "full"}, target={"partition": partition},
            source={"type": "sftp", "connection": "feed", "schema": "feed", "table": "orders", "path": path, "file_pattern": "*.csv",
                    "columns_ddl": "o_orderkey BIGINT, o_orderstatus STRING"})
        for part in ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1"):
            orders.where(part).write.mode("append").option("header", True).csv(path)
            run_load(spark, spec, state_database=database, force=True)
        loaded.append(ParquetTable(spark, database, "target").read().select("o_orderkey", "o_orderstatus"))
    both = loaded[0].unionByName(loaded[1]).groupBy("o_orderkey", "o_orderstatus")
    return both.agg(F.count(F.lit(1)).alias("layouts"))


@query("SELECT 'NO_DATA' AS status, CAST(0 AS BIGINT) AS in_target UNION ALL SELECT 'SUCCESS', CAST(count(*) AS BIGINT) FROM orders")
def load_no_files(spark, folder):
    """A feed without a file is no success: when files come later that day, they are loaded."""
    from tidemark.sinks.ledgers import RunLedger

    database, path = _database(spark), fresh_folder(spark, "feed")
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    spec = _spec(
        database, {"type": "full"},
        source={"type": "sftp", "connection": "feed", "schema": "feed", "table": "orders", "path": path, "file_pattern": "*.csv",
                "columns_ddl": "o_orderkey BIGINT, o_orderstatus STRING"})
    run_load(spark, spec, state_database=database)
    target = ParquetTable(spark, database, "target")
    before = target.read().count() if target.exists() else 0
    orders.write.option("header", True).csv(path)
    run_load(spark, spec, state_database=database)
    held = F.when(F.col("status") == "NO_DATA", before).otherwise(target.read().count()).cast("bigint")
    return RunLedger(spark, database).read().select("status", held.alias("in_target"))


@query("""
SELECT 'FAILED' AS status, CAST(0 AS BIGINT) AS refused, CAST(2 * count(*) AS BIGINT) AS kept, CAST(count(*) AS BIGINT) AS good FROM orders""")
def load_bad_rows(spark, folder):
    """Half of a file's rows do not fit its columns: the load is refused and the file
    audited; told to keep such rows, it loads them with NULLs."""
    from tidemark.plans.load import LoadFailed
    from tidemark.sinks.ledgers import FileAudit

    database, path = _database(spark), fresh_folder(spark, "feed")
    orders = _table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("k"), "o_orderstatus")
    orders.unionByName(orders.select(F.concat(F.lit("x"), "k").alias("k"), "o_orderstatus")).repartition(4, "o_orderstatus").write.option("header", True).csv(path)
    source = {"type": "sftp", "connection": "feed", "schema": "feed", "table": "orders", "path": path, "file_pattern": "*.csv",
              "columns_ddl": "k BIGINT, o_orderstatus STRING"}
    target = ParquetTable(spark, database, "target")
    try:
        run_load(spark, _spec(database, {"type": "full"}, source=source), state_database=database)
    except LoadFailed:
        pass
    refused = target.read().count() if target.exists() else 0
    failed = FileAudit(spark, database).read().select("status").first()[0]
    run_load(spark, _spec(database, {"type": "full"}, source=source | {"bad_rows": "keep"}), state_database=database)
    return target.read().agg(F.lit(failed).alias("status"), F.lit(refused).cast("bigint").alias("refused"),
                             F.count(F.lit(1)).alias("kept"), F.count("k").alias("good"))


@query("""
SELECT 'load' AS what, CAST(count(*) AS BIGINT) AS files_or_rows FROM orders UNION ALL
SELECT 'audited', CAST(count(*) AS BIGINT) FROM orders""")
def load_audits_files(spark, folder):
    """After a feed load, the file audit accounts for every row of the target."""
    from tidemark.sinks.ledgers import FileAudit

    database, path = _database(spark), _csv_feed(spark, folder)
    spec = _spec(
        database, {"type": "full"},
        source={"type": "sftp", "connection": "feed", "schema": "feed", "table": "orders", "path": path, "file_pattern": "*.csv"},
    )
    run_load(spark, spec, state_database=database)
    audited = FileAudit(spark, database).read().where("status = 'SUCCESS'").agg(F.sum("record_count").alias("files_or_rows"))
    loaded = ParquetTable(spark, database, "target").read().agg(F.count(F.lit(1)).alias("files_or_rows"))
    label = lambda df, name: df.select(F.lit(name).alias("what"), "files_or_rows")
    return label(loaded, "load").unionAll(label(audited, "audited"))


@query("""
SELECT 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_type, CAST(count(*) AS BIGINT) AS rows_written, CAST(count(*) AS BIGINT) AS in_target FROM lineitem
UNION ALL SELECT 'FAILED', 'QualityError', NULL, CAST(count(*) AS BIGINT) FROM lineitem""")
def load_gate_failure(spark, folder):
    """The second load repeats keys: it is refused and recorded, the target stays."""
    from tidemark.sinks.ledgers import RunLedger

    database, lineitem = _database(spark), _table(spark, folder, "lineitem")
    run_load(spark, _spec(database, {"type": "full"}), batch=lineitem, state_database=database)
    gated = _spec(database, {"type": "full"}, data_quality={"unique_check": ["l_orderkey", "l_linenumber"]})
    try:
        run_load(spark, gated, batch=lineitem.unionAll(lineitem), state_database=database, force=True)
    except quality.QualityError:
        pass
    held = ParquetTable(spark, database, "target").read().count()
    runs = RunLedger(spark, database).read()
    return runs.select("status", "error_type", "rows_written", F.lit(held).cast("bigint").alias("in_target"))


@query("""
SELECT 'on_quality_failure' AS event_type, 'DATA_QUALITY_FAILED' AS pipeline_status, 'dq@example.org' AS recipients_to,
       'minimum_rows: ' || count(*) || ' row(s), at least ' || (count(*) + 1) || ' required' AS error_message FROM orders""")
def load_failure_notice(spark, folder):
    """Who should hear of a refused load, by the routing rules of its spec."""
    from tidemark.sinks.ledgers import NotificationAudit

    database, orders = _database(spark), _table(spark, folder, "orders")
    spec = _spec(
        database, {"type": "full"}, data_quality={"minimum_rows": orders.count() + 1},
        email_notification={"enabled": True, "to": "ops@example.org", "events": [
            {"event": "on_failure", "to": "on-call@example.org"}, {"event": "on_quality_failure", "to": "dq@example.org"}]},
    )
    try:
        run_load(spark, spec, batch=orders, state_database=database)
    except quality.QualityError:
        pass
    return NotificationAudit(spark, database).read().select("event_type", "pipeline_status", "recipients_to", "error_message")


@query("""
SELECT 'on_missing_file' AS event_type, 'MISSING_FILE' AS pipeline_status, 'feeds@example.org' AS recipients_to, CAST(0 AS BIGINT) AS in_target
UNION ALL SELECT 'on_sla_breach', 'SLA_BREACHED', 'ops@example.org', CAST(count(*) AS BIGINT) FROM orders""")
def load_monitor_events(spark, folder):
    """A feed whose file is missing, then a load beyond its limit, each with its event."""
    from tidemark.sinks.ledgers import NotificationAudit

    database, path = _database(spark), fresh_folder(spark, "feed")
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    spec = _spec(
        database, {"type": "full"}, task={"task_id": "job", "task_name": "job", "sla_seconds": 1},
        source={"type": "sftp", "connection": "feed", "schema": "feed", "table": "orders", "path": path, "columns_ddl": "o_orderkey BIGINT, o_orderstatus STRING"},
        email_notification={"enabled": True, "to": "ops@example.org", "events": [{"event": "on_missing_file", "to": "feeds@example.org"}]})
    run_load(spark, spec, state_database=database)
    orders.write.option("header", True).csv(path)
    slow = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(minutes=5)
    run_load(spark, spec, state_database=database, started=slow)
    held = F.when(F.col("event_type") == "on_sla_breach", ParquetTable(spark, database, "target").read().count()).otherwise(0).cast("bigint")
    return NotificationAudit(spark, database).read().select("event_type", "pipeline_status", "recipients_to", held.alias("in_target"))


@query("""
SELECT event_type AS job_id, strftime(max(date_trunc('week', ts)), '%Y-%m-%d') AS watermark, CAST(count(DISTINCT date_trunc('week', ts)) AS BIGINT) AS commits,
       CAST(1 AS BIGINT) AS partitions FROM events GROUP BY 1""")
def ledger_roll_up(spark, folder):
    """A commit for each week and kind of event, rolled up to one for each kind."""
    from tidemark.sinks.ledgers import WatermarkStore

    days = _table(spark, folder, "events").select("event_type", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("day")).distinct()
    store = WatermarkStore(spark, _database(spark))
    for row in sorted(days.collect()):  # a commit each
        store.put(row["event_type"], row["day"])
    store.ledger.roll_up()
    parts = spark.sql(f"SHOW PARTITIONS {store.ledger.name}").select(F.regexp_extract("partition", "job_id=([^/]*)/", 1).alias("job_id"))
    parts = parts.groupBy("job_id").agg(F.count(F.lit(1)).alias("partitions"))
    commits = store.ledger.read().groupBy("job_id").agg(F.count(F.lit(1)).alias("commits"))
    now = store.current().select("job_id", F.col("watermark_value").alias("watermark"))
    return now.join(commits, "job_id").join(parts, "job_id")


@query("SELECT o_orderkey, date_trunc('year', o_orderdate)::TIMESTAMP AS year, CAST(1 AS BIGINT) AS copies FROM orders")
def load_late_ties(spark, folder):
    """Appends by a watermark that very many rows share. Rows of the last value that come
    late are loaded, and none twice, be the batch empty or repeated."""
    database, orders = _database(spark), _table(spark, folder, "orders")
    rows = orders.select("o_orderkey", F.date_trunc("year", "o_orderdate").cast("timestamp_ntz").alias("year"))
    [mid] = rows.agg(F.percentile_approx("year", 0.5)).first()
    early, at = F.col("year") < F.lit(mid), F.col("year") == F.lit(mid)
    spec = _spec(database, {"type": "incremental", "incremental": {"column": "year"}})
    for part in (early | (at & (F.col("o_orderkey") % 2 == 0)), early | at, early | at, F.col("year") < F.lit("1900-01-01").cast("timestamp_ntz"), F.lit(True)):
        run_load(spark, spec, batch=rows.where(part), state_database=database, force=True)
    return ParquetTable(spark, database, "target").read().groupBy("o_orderkey", "year").agg(F.count(F.lit(1)).alias("copies"))


@query("""
SELECT s.stage, event_type, CAST(count(*) AS BIGINT) AS n, CAST(s.partitions AS BIGINT) AS partitions
FROM events, (VALUES ('before', 3), ('stopped', 4), ('after', 1)) AS s(stage, partitions) GROUP BY ALL""")
def ledger_roll_up_stopped(spark, folder):
    """Three commits for each kind of event, merged by a roll-up that stops before it has
    detached them: readers count the same before, then and after the next roll-up."""
    from tidemark.sinks.ledgers import Ledger

    class Stopping(Ledger):
        def detach(self, commits):
            if any(commits.values()):
                raise InterruptedError

    database, events = _database(spark), _table(spark, folder, "events").select("event_id", "event_type")
    book = Ledger(spark, database, "book", "event_id bigint, event_type string", "event_type", "string")
    kinds = [r[0] for r in events.select("event_type").distinct().collect()]  # a few
    for kind in kinds:
        for k in range(3):
            book.append(events.where((F.col("event_type") == kind) & (F.pmod("event_id", F.lit(3)) == k)), kind)

    def seen(stage):
        counts = book.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        held = spark.createDataFrame([(k, len(c)) for k, c in book.commits().items()], "event_type string, partitions bigint")
        out = counts.join(held, "event_type").select(F.lit(stage).alias("stage"), "event_type", "n", "partitions")
        path = fresh_folder(spark, stage)
        out.write.parquet(path)  # as it is now
        return spark.read.parquet(path)

    before = seen("before")
    try:
        Stopping(spark, database, "book", "event_id bigint, event_type string", "event_type", "string").roll_up()
    except InterruptedError:
        pass
    stopped = seen("stopped")
    book.roll_up()
    return before.unionByName(stopped).unionByName(seen("after"))


@query("""
SELECT event_id, event_type, ts, CASE WHEN event_id % 5 = 0 THEN 'new' ELSE 'old' END AS state FROM events
WHERE NOT (event_type = 'error' AND CAST(ts AS DATE) = (SELECT CAST(min(ts) AS DATE) FROM events))""")
def sink_two_columns(spark, folder):
    """A table by day and kind: written, one of its partitions emptied, others merged into."""
    from tidemark.functions.partitioning import PartitionRules

    events = _table(spark, folder, "events").select("event_id", "event_type", "ts", F.lit("old").alias("state"))
    target = ParquetTable(spark, _database(spark), "target", PartitionRules.parse("days(ts), event_type"))
    target.publish_new(target.stage(events))
    [day] = events.agg(F.min(F.to_date("ts"))).first()
    lost = (F.col("event_type") == "error") & (F.to_date("ts") == F.lit(day))
    # keys of another partition: the rows of one pair of values move to another day, and go from there
    moved = events.where(lost).withColumn("ts", F.lit("1999-01-01").cast("timestamp_ntz"))
    target.merge(moved, ["event_id"])
    kept = target.read().where(F.col("ts") > F.lit("2000-01-01").cast("timestamp_ntz"))
    fresh = events.where((F.col("event_id") % 5 == 0) & ~lost).withColumn("state", F.lit("new"))
    target.merge(fresh, ["event_id"])
    return kept


@query("SELECT count(*) AS n, count(*) AS in_one_split, true AS balanced FROM lineitem")
def scan_equal_splits(spark, folder):
    """Lineitem in 16 splits by part: every row is in exactly one, the largest has less than twice the mean."""
    from tidemark.sources.splits import equal_splits

    return _splits_report(_table(spark, folder, "lineitem"), ["l_partkey"], 16, equal_splits)


@query("SELECT count(*) AS n, count(*) AS in_one_split, true AS balanced FROM lineitem")
def scan_equal_splits_skewed(spark, folder):
    """The same by a column of which one value, and no value, have a third of all rows each:
    these are cut by the order."""
    from tidemark.sources.splits import equal_splits

    key = F.col("l_orderkey") % 3
    skewed = _table(spark, folder, "lineitem").withColumn("k", F.when(key == 0, 5).when(key == 1, F.col("l_partkey")))
    return _splits_report(skewed, ["k", "l_orderkey"], 16, equal_splits)


def _splits_report(df, columns, number, equal_splits):
    splits = equal_splits(df, columns, number)
    inside = F.array(*[F.coalesce(s.condition, F.lit(False)) for s in splits])
    counts = df.select(F.size(F.filter(inside, lambda x: x)).alias("hits"), F.array_position(inside, True).alias("split")).groupBy("split", "hits").agg(
        F.count(F.lit(1)).alias("rows"))
    return counts.agg(
        F.sum("rows").alias("n"), F.sum(F.when(F.col("hits") == 1, F.col("rows"))).alias("in_one_split"),
        (F.max("rows") < 2 * F.sum("rows") / number).alias("balanced"))


@query("SELECT CAST(1 AS BIGINT) AS versions, CAST(1 AS BIGINT) AS expired, CAST(count(*) AS BIGINT) AS n FROM orders")
def expire_versions(spark, folder):
    """A replaced table loses its old version after the retention."""
    orders = _table(spark, folder, "orders")
    target = _filled(spark, orders.where("o_orderstatus = 'F'"))
    target.publish_replace(target.stage(orders))
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(days=4)
    expired = maintenance.expire_versions(target, older_than_days=3, now=later)
    left = maintenance.versions(target).agg(F.count(F.lit(1)).alias("versions"), F.lit(expired).cast("bigint").alias("expired"))
    return left.crossJoin(target.read().agg(F.count(F.lit(1)).alias("n")))  # a row each


@query("""
SELECT 'good' AS what, o_orderkey::VARCHAR AS k, o_orderstatus AS detail FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'rejected', 'x' || o_orderkey || ',' || o_orderstatus, 'o_orderkey: x' || o_orderkey || ' is no bigint' FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT 'rejected', 'y' || o_orderkey || ',' || o_orderstatus, 'o_orderkey: y' || o_orderkey || ' is no bigint' FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'refused', 'P', 'FAILED' UNION ALL SELECT 'accepted', 'other', 'SUCCESS'""")
def load_quarantine(spark, folder):
    """A feed of which one part has a few rows that do not fit, another nothing but such
    rows: the good rows of the former are loaded, the bad ones of both stand apart with their
    reason, and the files of the latter are refused."""
    from tidemark.sinks.ledgers import FileAudit

    database, path = _database(spark), fresh_folder(spark, "feed")
    orders = _table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus")
    pending = F.col("o_orderstatus") == "P"
    some = orders.where("o_orderkey % 50 = 0").withColumn("o_orderkey", F.concat(F.lit("x"), "o_orderkey"))
    # bad rows lie among good ones of their file
    other = orders.where(~pending).unionByName(some).repartition(4, F.pmod(F.regexp_replace("o_orderkey", "x", "").cast("bigint"), F.lit(7)))
    other.write.option("header", True).csv(f"{path}/other")
    # by ranges, as the first of them has rows: a task without any would write a file of a header alone, which is none to refuse
    misfits = orders.where(pending).withColumn("o_orderkey", F.concat(F.lit("y"), "o_orderkey")).repartitionByRange(4, "o_orderkey")
    misfits.write.option("header", True).csv(f"{path}/P")
    spec = _spec(
        database, {"type": "incremental", "incremental": {"column": "o_orderkey", "watermark_type": "numeric"}},
        source={"type": "sftp", "connection": "feed", "schema": "feed", "table": "orders", "path": path, "file_pattern": "*.csv",
                "columns_ddl": "o_orderkey BIGINT, o_orderstatus STRING", "bad_rows": "quarantine", "bad_share": 0.5})
    run_load(spark, spec, state_database=database)
    good = ParquetTable(spark, database, "target").read().select(F.lit("good").alias("what"), F.col("o_orderkey").cast("string").alias("k"), F.col("o_orderstatus").alias("detail"))
    bad = spark.table(identifier(database, "target_rejected")).select(F.lit("rejected").alias("what"), F.col("raw_text").alias("k"), F.col("reason").alias("detail"))
    files = FileAudit(spark, database).read().select(
        F.when(F.col("status") == "FAILED", "refused").otherwise("accepted").alias("what"),
        F.regexp_extract("file_path", "/([^/]*)/[^/]*$", 1).alias("k"), F.col("status").alias("detail")).distinct()
    return good.unionByName(bad).unionByName(files)


@query("""
SELECT o_orderkey, o_orderstatus, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS loads FROM orders""")
def load_feed_incremental(spark, folder):
    """Three upserts of a feed: all files, nothing, then only a rewritten and a new file are
    read. Each row has the number of the load that brought it."""
    database, path = _database(spark), fresh_folder(spark, "feed")
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    finished, opened = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    read = []

    def load(number):
        spec = _spec(
            database, {"type": "upsert", "incremental": {"column": "loads", "watermark_type": "numeric"}}, keys={"merge_keys": ["o_orderkey"]},
            source={"type": "sftp", "connection": "feed", "schema": "feed", "table": "orders", "path": path, "file_pattern": "*.csv",
                    "columns_ddl": "o_orderkey BIGINT, o_orderstatus STRING"},
            transform={"derived": {"loads": f"CAST({number} AS BIGINT)"}})
        read.append(run_load(spark, spec, state_database=database, force=True).rows_read)

    write = lambda rows, name: rows.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
    write(orders.where(finished), "finished")
    write(orders.where(opened).withColumn("o_orderstatus", F.lit("?")), "open")
    load(1)
    load(9)  # no new file
    write(orders.where(opened), "open")
    write(orders.where(~finished & ~opened), "pending")
    load(2)
    if read != [orders.where(finished | opened).count(), 0, orders.where(~finished).count()]:
        raise AssertionError(f"rows read: {read}")
    return ParquetTable(spark, database, "target").read()


@query("""
WITH d AS (SELECT o_orderkey % 1000 AS k, count(*) AS n FROM orders GROUP BY 1),
bad AS (SELECT count(*) AS nulls FROM orders WHERE o_orderstatus = 'P')
SELECT 'null_check' AS rule, CAST(least(nulls, 50) AS BIGINT) AS shown, CAST(least(nulls, 50) AS BIGINT) AS violating, CAST(0 AS BIGINT) AS in_target FROM bad WHERE nulls > 0
UNION ALL SELECT 'unique_check', least(sum(n), 50)::BIGINT, least(sum(n), 50)::BIGINT, 0::BIGINT FROM d WHERE n > 1 HAVING count(*) > 0""")
def load_refused_samples(spark, folder):
    """A load refused for NULLs and one for repeated keys, each with up to 50 of the rows it
    was refused for."""
    from tidemark.sinks.ledgers import QualitySamples

    database, orders = _database(spark), _table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    batches = {
        "null_check": orders.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))),
        "unique_check": orders.withColumn("o_orderkey", F.col("o_orderkey") % 1000)}
    for rule, column in (("null_check", "o_orderstatus"), ("unique_check", "o_orderkey")):
        try:
            run_load(spark, _spec(database, {"type": "full"}, data_quality={rule: [column]}), batch=batches[rule], state_database=database, force=True)
        except quality.QualityError:
            pass
    target = ParquetTable(spark, database, "target")
    held = target.read().count() if target.exists() else 0
    rows = QualitySamples(spark, database).read().withColumn("v", F.from_json("row", "o_orderkey BIGINT, o_orderstatus STRING"))
    repeated = batches["unique_check"].groupBy("o_orderkey").count().where("count > 1").select(F.col("o_orderkey").alias("k"))
    rows = rows.join(repeated, F.col("v.o_orderkey") == F.col("k"), "left")
    bad = F.when(F.col("rule") == "null_check", F.col("v.o_orderstatus").isNull()).otherwise(F.col("k").isNotNull())
    return rows.groupBy("rule").agg(F.count(F.lit(1)).alias("shown"), F.count_if(bad).alias("violating")).withColumn("in_target", F.lit(held).cast("bigint"))


@query("""
SELECT 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_type, CAST(count(*) AS BIGINT) AS in_target FROM customer
UNION ALL SELECT 'FAILED', 'QualityError', CAST(count(*) AS BIGINT) FROM customer
UNION ALL SELECT 'FAILED', 'QualityError', CAST(count(*) AS BIGINT) FROM customer""")
def load_primary_key(spark, folder):
    """A primary key that is checked where the spec asks for it: a batch that repeats one, and
    one that lacks one, are refused."""
    from tidemark.sinks.ledgers import RunLedger

    database, customer = _database(spark), _table(spark, folder, "customer").select("c_custkey", "c_name")
    spec = _spec(database, {"type": "full"}, keys={"primary_key": ["C_CUSTKEY"]}, data_quality={"check_null_keys": True, "check_duplicate_keys": True})
    lacking = customer.withColumn("c_custkey", F.when(F.col("c_custkey") % 100 != 0, F.col("c_custkey")))
    for batch in (customer, customer.unionAll(customer.where("c_custkey % 7 = 0")), lacking):
        try:
            run_load(spark, spec, batch=batch, state_database=database, force=True)
        except quality.QualityError:
            pass
    held = ParquetTable(spark, database, "target").read().count()
    return RunLedger(spark, database).read().select("status", "error_type", F.lit(held).cast("bigint").alias("in_target"))


@query("""
SELECT 'customer' AS name, 'updated_at_day' AS partitions, CAST(count(*) AS BIGINT) AS n FROM customer UNION ALL
SELECT 'mysql_orders', 'created_at_day', count(*)::BIGINT FROM orders UNION ALL
SELECT 'etl_email_audit', 'sent_timestamp_day,email_status', count(*)::BIGINT FROM events""")
def sink_fixed_tables(spark, folder):
    """Bronze and governance tables by their fixed columns and partitioning, filled by name."""
    from pyspark.sql import types as T
    from tidemark.functions.partitioning import PartitionRules
    from tidemark.sinks import ddl

    database = _database(spark)
    when = F.lit("2024-01-01").cast("timestamp")
    rows = {
        "customer": _table(spark, folder, "customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance"), when.alias("updated_at")),
        "mysql_orders": _table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.date_trunc("year", "o_orderdate").cast("timestamp").alias("created_at")),
        "etl_email_audit": _table(spark, folder, "events").select(
            F.col("event_id").cast("string").alias("notification_id"), F.col("ts").cast("timestamp").alias("sent_timestamp"), F.col("event_type").alias("email_status"))}
    made = None
    for name, batch in rows.items():
        if name in ddl.BRONZE:
            columns, kind, column = ddl.BRONZE[name]
            rule = PartitionRule.parse(kind, column)
        else:
            columns, by = ddl.GOVERNANCE[name]
            rule = PartitionRules.parse(by)
        table = ParquetTable(spark, database, name, rule)
        table.create(T.StructType.fromDDL(columns))
        table.append(batch)
        counted = table.read().agg(F.lit(name).alias("name"), F.lit(",".join(table.partition.names)).alias("partitions"), F.count(F.lit(1)).alias("n"))
        made = counted if made is None else made.unionByName(counted)
    return made


@query("""
SELECT count(*) AS files, count(DISTINCT o_orderkey) AS paths, CAST(0 AS BIGINT) AS new_files FROM orders""")
def feed_state_snapshot(spark, folder):
    """The state of a feed's files as a snapshot and the days after it: each order stands for a
    file that was loaded on its day, a fifth of them once more, rewritten, on the last one."""
    from tidemark.sinks.ledgers import FileAudit

    audit, orders = FileAudit(spark, _database(spark)), _table(spark, folder, "orders")
    [first, last] = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    listing = orders.select(
        F.col("o_orderkey").cast("string").alias("file_name"), F.col("o_orderkey").cast("string").alias("file_path"), F.col("o_custkey").alias("file_size"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSS").alias("last_modified"), F.lit(None).cast("string").alias("file_owner"))
    counts = listing.select("file_path", F.lit(1).cast("bigint").alias("record_count"))
    rewritten = listing.where("file_path % 5 = 0").withColumn("file_size", F.col("file_size") + 1)
    audit.record(listing, counts, "t", at=first)
    audit.snapshot("t", (first + dt.timedelta(days=1)).date())
    audit.record(rewritten, counts, "t", at=last)
    audit.snapshot("t", (last + dt.timedelta(days=1)).date())
    now = listing.where("file_path % 5 <> 0").unionByName(rewritten)
    new = feeds.new_files(now, audit.loaded("t")).agg(F.count(F.lit(1)).alias("new_files"))
    known = audit.loaded("t").agg(F.count(F.lit(1)).alias("files"), F.count_distinct("file_path").alias("paths"))
    return known.crossJoin(new)  # a row each


# --- driver contract ------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """A full load of orders by spec, then orders and revenue per status."""
    database = _database(spark)
    spec = _spec(
        database, {"type": "full"},
        transform={"rename": {"o_orderkey": "order_id"}, "cast": {"o_totalprice": "DECIMAL(18,2)"}},
        data_quality={"null_check": ["order_id"], "unique_check": ["order_id"], "minimum_rows": 1},
        target={"partition": {"type": "years", "column": "o_orderdate"}},
    )
    run_load(spark, spec, batch=_table(spark, "/root/testdata/sf0.001", "orders"), state_database=database)
    loaded = spark.table(identifier(database, "target"))
    return loaded.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("decimal(28,2)").alias("total"))


try:
    from tidemark.llm import queries as _llm
except ImportError:
    _llm = None
else:
    _QUERIES.update(_llm.QUERIES)
    _SQL.update(_llm.SQL)

try:
    import corpus_pipeline as _pipeline
except ImportError:
    _pipeline = None
else:
    _QUERIES["pipeline"] = _pipeline.run
    if _pipeline.ORACLE_SQL:
        _SQL["pipeline"] = _pipeline.ORACLE_SQL


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, sql in _SQL.items()}
