import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from tidemark.functions.partitioning import PartitionRule, PartitionRules
from tidemark.operators.merge import upsert
from tidemark.operators.schema import SchemaError
from tidemark.operators.watermark import Watermark
from tidemark.sinks import maintenance
from tidemark.sinks.tables import MergeError, ParquetTable
from tidemark.sources import tables


def new_table(spark, database, df, rule=None, name="t"):
    table = ParquetTable(spark, database, name, rule)
    table.publish_new(table.stage(df))
    return table


@pytest.fixture
def small(spark):
    return spark.createDataFrame(
        [(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 2)), (3, "c", None)], "k int, v string, d date"
    )


def test_create_and_read_hides_the_derived_column(spark, database, orders):
    table = new_table(spark, database, orders, PartitionRule.parse("years", "o_orderdate"))
    assert table.read().columns == orders.columns
    assert "o_orderdate_year" in spark.table(table.name).columns
    assert values(table.read()) == values(orders)


@pytest.mark.parametrize("kind,column", [
    ("days", "o_orderdate"), ("hours", "o_orderdate"), ("months", "o_orderdate"), ("years", "o_orderdate"),
    ("bucket(8)", "o_orderkey"), (None, "o_orderstatus"), ("identity", "o_orderpriority"),
])
def test_every_transform_round_trips(spark, database, orders, kind, column):
    some = orders.where("o_orderdate < timestamp_ntz'1995-03-01'")
    table = new_table(spark, database, some, PartitionRule.parse(kind, column))
    assert values(table.read(), *some.columns) == values(some)
    again = ParquetTable(spark, database, "t")
    assert again.partition == PartitionRule.parse(kind, column)


def test_full_replace_leaves_nothing_behind(spark, database, orders):
    for name, rule in (("plain", None), ("parts", PartitionRule.parse("years", "o_orderdate"))):
        table = new_table(spark, database, orders, rule, name)
        late = orders.where("o_orderdate >= timestamp_ntz'2001-01-01'")
        table.publish_replace(table.stage(late))
        assert values(table.read()) == values(late)
        table.publish_replace(table.stage(late))
        assert values(table.read()) == values(late)


def test_a_plan_made_before_the_switch_still_reads_the_old_rows(spark, database, orders):
    table = new_table(spark, database, orders)
    before = table.read()
    table.publish_replace(table.stage(orders.where("o_orderstatus = 'F'")))
    assert before.count() == orders.count()


def test_overwrite_partitions_keeps_the_others(spark, database, orders):
    table = new_table(spark, database, orders, PartitionRule.parse("years", "o_orderdate"))
    batch = orders.where("year(o_orderdate) = 2000 AND o_orderstatus = 'F'")
    table.publish_partitions(table.stage(batch))
    assert values(table.read()) == values(orders.where("year(o_orderdate) <> 2000 OR o_orderstatus = 'F'"))


def test_append_copies_or_attaches(spark, database, orders):
    rule = PartitionRule.parse("years", "o_orderdate")
    table = new_table(spark, database, orders.where("year(o_orderdate) < 2000"), rule)
    staged = table.stage(orders.where("year(o_orderdate) >= 2000"))
    table.publish_append(staged)  # new partitions only: attached where they are
    assert any(staged.path.split("/")[-1] in f for f in spark.table(table.name).inputFiles())
    assert values(table.read()) == values(orders)
    table.publish_append(table.stage(orders.where("year(o_orderdate) = 2000")))
    assert table.read().count() == orders.count() + orders.where("year(o_orderdate) = 2000").count()


def test_partition_values_with_special_characters_and_null(spark, database):
    rows = [(1, "a b:c/d%e"), (2, None), (3, "x='y'"), (4, "plain"), (5, "back\\slash")]
    df = spark.createDataFrame(rows, "k int, p string")
    table = new_table(spark, database, df, PartitionRule.parse(None, "p"))
    assert values(table.read(), "k", "p") == values(df)
    changed = df.withColumn("k", F.col("k") + 10)
    table.publish_partitions(table.stage(changed))
    assert values(table.read(), "k", "p") == values(changed)
    table.merge(spark.createDataFrame([(11, "plain"), (12, "x='y'"), (15, None)], "k int, p string"), ["k"])
    assert values(table.read(), "k", "p") == values(spark.createDataFrame(
        [(11, "plain"), (12, "x='y'"), (13, "x='y'"), (14, "plain"), (15, None)], "k int, p string"))


def brute_merge(target, source, keys, columns):
    """MERGE row by row."""
    at = [columns.index(k) for k in keys]
    key = lambda row: tuple(row[i] for i in at)
    by_key = {key(r): r for r in source if None not in key(r)}
    out = [by_key.get(key(r), r) if None not in key(r) else r for r in target]
    held = {key(r) for r in target if None not in key(r)}
    return out + [r for r in source if None in key(r) or key(r) not in held]


@pytest.mark.parametrize("kind,column", [(None, None), ("days", "d"), ("bucket(4)", "k"), ("identity", "g")])
@pytest.mark.parametrize("seed", [1, 2])
def test_merge_equals_brute_force(spark, database, kind, column, seed):
    rnd = random.Random(seed)
    day = lambda: dt.date(2024, 1, rnd.randint(1, 5)) if rnd.random() > 0.1 else None
    schema = "k int, g string, v int, d date"
    rows = [(rnd.choice([*range(20), None]), rnd.choice("ab"), rnd.randint(0, 9), day()) for _ in range(60)]
    keys = {(k, g) for k in [*range(10, 30), None] for g in "ab"}
    batch = [(k, g, rnd.randint(100, 109), day()) for k, g in sorted(keys, key=str)]
    table = new_table(spark, database, spark.createDataFrame(rows, schema), PartitionRule.parse(kind, column))
    table.merge(spark.createDataFrame(batch, schema), ["k", "g"])
    expected = spark.createDataFrame(brute_merge(rows, batch, ["k", "g"], ["k", "g", "v", "d"]), schema)
    assert values(table.read(), "k", "g", "v", "d") == values(expected)


def test_merge_is_idempotent(spark, database, orders):
    table = new_table(spark, database, orders, PartitionRule.parse("years", "o_orderdate"))
    batch = orders.where("year(o_orderdate) = 1999").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    table.merge(batch, ["o_orderkey"])
    once = values(table.read())
    table.merge(batch, ["o_orderkey"])
    assert values(table.read()) == once


def test_merge_rewrites_only_touched_partitions(spark, database, orders):
    table = new_table(spark, database, orders, PartitionRule.parse("years", "o_orderdate"))
    before = {f for f in spark.table(table.name).inputFiles()}
    moved = orders.where("year(o_orderdate) = 1996").withColumn("o_orderdate", F.lit("1998-05-05").cast("timestamp_ntz"))
    table.merge(moved, ["o_orderkey"])
    after = {f for f in spark.table(table.name).inputFiles()}
    untouched = {f for f in before if "year=1996" not in f and "year=1998" not in f}
    assert untouched <= after and not {f for f in before - untouched} & after
    assert table.read().where("year(o_orderdate) = 1996").count() == 0  # emptied partition is gone
    assert "o_orderdate_year=1996" not in table._partition_specs()


def test_merge_refuses_ambiguous_source(spark, database, small):
    table = new_table(spark, database, small)
    with pytest.raises(MergeError):
        table.merge(small.union(small), ["k"])
    with pytest.raises(ValueError):
        upsert(small, small, [])


def test_merge_preserve_and_newer(spark):
    schema = "k int, v string, ins string, at int"
    target = spark.createDataFrame([(1, "a", "run_1", 5), (2, "b", "run_1", 5)], schema)
    source = spark.createDataFrame([(1, "A", "run_2", 6), (2, "B", "run_2", 4), (3, "C", "run_2", 1)], schema)
    assert values(upsert(target, source, ["K"], preserve=["INS"])) == [
        (1, "A", "run_1", 6), (2, "B", "run_1", 4), (3, "C", "run_2", 1)]
    assert values(upsert(target, source, ["k"], newer_by=["at"])) == [
        (1, "A", "run_2", 6), (2, "b", "run_1", 5), (3, "C", "run_2", 1)]


def test_a_hot_target_key_is_split_in_the_merge_join(spark):
    hot = spark.range(200000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    source = spark.range(0, 200000, 5).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    session = spark.newSession()
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
        "spark.sql.shuffle.partitions": "16",
    }.items():
        session.conf.set(name, value)
    import tempfile
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    hot.repartition(8).write.parquet(f"{folder}/t")
    source.write.parquet(f"{folder}/s")
    merged = upsert(session.read.parquet(f"{folder}/t"), session.read.parquet(f"{folder}/s"), ["k"])
    assert merged.count() == 200000 + session.read.parquet(f"{folder}/s").join(
        session.read.parquet(f"{folder}/t"), "k", "left_anti").count()
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_reconcile_adds_widens_and_refuses(spark, database, small):
    table = new_table(spark, database, small)
    more = small.withColumn("extra", F.lit(1.5))
    with pytest.raises(SchemaError):
        table.reconcile(more.schema, evolution=False)
    with pytest.raises(SchemaError):
        table.reconcile(more.schema, add_columns=False)
    with pytest.raises(SchemaError):
        table.reconcile(small.withColumn("k", F.col("k").cast("string")).schema)
    assert table.reconcile(more.schema) == ["extra"]
    table.append(more.withColumn("k", F.col("k").cast("smallint")))
    assert table.read().where("extra is null").count() == 3
    assert table.read().where("extra = 1.5").count() == 3
    assert table.schema()["k"].dataType.simpleString() == "int"


def test_compaction_keeps_the_rows(spark, database, orders):
    many = orders.repartition(40)
    plain = new_table(spark, database, many, None, "plain")
    assert maintenance.compact(plain) == 40
    assert len(spark.table(plain.name).inputFiles()) == 1
    assert values(plain.read()) == values(orders)
    assert maintenance.compact(plain) == 0

    parts = ParquetTable(spark, database, "parts", PartitionRule.parse("years", "o_orderdate"))
    parts.publish_new(parts.stage(many, rebalance=False))
    before = len(spark.table(parts.name).inputFiles())
    assert before > 200 and maintenance.compact(parts) == before
    assert len(spark.table(parts.name).inputFiles()) == len(parts._partition_specs())
    assert values(parts.read()) == values(orders)


@pytest.mark.parametrize("kind", [None, "years"])
def test_an_empty_table_survives_maintenance(spark, database, orders, kind):
    table = new_table(spark, database, orders, PartitionRule.parse(kind, "o_orderdate" if kind else None))
    table.publish_replace(table.stage(orders.where("o_orderkey < 0")))
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(days=10)
    assert maintenance.expire_versions(table, now=later) == (0 if kind else 1)
    maintenance.remove_orphans(table, now=later)
    assert maintenance.find_orphans(table, now=later).count() == 0
    assert table.read().count() == 0
    table.append(orders)
    assert values(table.read()) == values(orders)


def test_compaction_makes_files_of_the_target_size_of_neighbours(spark, database):
    same = spark.range(40000).select(F.lit("x").alias("p"), F.lit(5).alias("v"), F.sha2(F.lit("a"), 512).alias("s"))
    other = spark.range(2000).select(F.lit("y").alias("p"), F.col("id").cast("int").alias("v"), F.sha2(F.col("id").cast("string"), 512).alias("s"))
    table = ParquetTable(spark, database, "t", PartitionRule.parse(None, "p"))
    table.publish_new(table.stage(same.union(other).repartition(30), rebalance=False))
    sizes = {r["partition"]: r for r in maintenance.compaction_plan(maintenance.table_files(table), 0.03).collect()}
    assert sizes["x"]["rewrite"] and sizes["x"]["target_files"] >= 2
    assert maintenance.compact(table, 0.03) == sum(r["files"] for r in sizes.values() if r["rewrite"])
    counts = [r["count"] for r in spark.table(table.name).where("p = 'x'").groupBy("_metadata.file_path").count().collect()]
    assert sum(counts) == 40000 and len(counts) > 1 and max(counts) < 3 * 40000 / sizes["x"]["target_files"]

    assert table.read().where("p = 'y'").count() == 2000


def test_scan_prunes_partitions_and_columns(spark, database, orders):
    table = new_table(spark, database, orders, PartitionRule.parse("months", "o_orderdate"))
    out = tables.scan(spark, table.name, ["o_orderkey"], Watermark("o_orderdate", "2000-05-17 00:00:00"), table.partition)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "(o_orderdate_month" in plan.split("PartitionFilters:")[1].split("]")[0] and ">= 2000-05" in plan
    assert "GreaterThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_orphans_and_expired_versions(spark, database, orders):
    table = new_table(spark, database, orders)
    first = {f.replace("file:///", "file:/") for f in spark.table(table.name).inputFiles()}
    table.publish_replace(table.stage(orders.where("o_orderstatus = 'F'")))
    assert maintenance.find_orphans(table).count() == 0  # too young
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(days=10)
    found = {r["file_path"] for r in maintenance.find_orphans(table, now=later).collect()}
    assert found == first
    assert maintenance.versions(table).where("used_files = 0").count() == 1
    assert maintenance.expire_versions(table, now=later) == 1
    assert maintenance.find_orphans(table, now=later).count() == 0
    assert values(table.read()) == values(orders.where("o_orderstatus = 'F'"))
    table.publish_replace(table.stage(orders))
    assert maintenance.remove_orphans(table, now=later) == 1
    assert values(table.read()) == values(orders)


def test_schema_diff(spark):
    from pyspark.sql import types as T
    from tidemark.operators.schema import diff

    source = T.StructType.fromDDL("ID int, amt decimal(10,2), note string, s string")
    target = T.StructType.fromDDL("id bigint, amt decimal(18,2), s int")
    assert [tuple(r) for r in diff(spark, source, target).collect()] == [
        ("ID", "int", "bigint", "widen"), ("amt", "decimal(10,2)", "decimal(18,2)", "widen"),
        ("note", "string", None, "add"), ("s", "string", "int", "conflict")]


def test_compaction_keeps_key_spans(spark, database):
    rows = spark.range(0, 40_000, 1, 40).select(F.lit("x").alias("p"), "id")
    table = ParquetTable(spark, database, "spans", PartitionRule.parse(None, "p"))
    table.publish_new(table.stage(rows, rebalance=False))
    files = maintenance.table_files(table).agg(F.count("*"), F.sum("file_size")).first()
    maintenance.compact(table, files[1] / 8 / 2**20)
    span = spark.table(table.name).groupBy("_metadata.file_path").agg((F.max("id") - F.min("id")).alias("s")).agg(F.max("s"), F.count("*")).first()
    assert 4 <= span[1] <= 20 and span[0] < 40_000 / 4 and table.read().count() == 40_000


def test_a_merge_reads_its_target_once(spark, database, orders):
    from tidemark.operators.merge import update_matched

    table = ParquetTable(spark, database, "once")
    table.publish_new(table.stage(orders))
    plan = update_matched(table.read(), orders.limit(5), ["o_orderkey"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("once") <= 1 and plan.lower().count("relation") == 2
    table.merge(orders.limit(5), ["o_orderkey"])
    assert set(spark.read.parquet(table.location).columns) == set(orders.columns)


@pytest.mark.parametrize("rows,broadcast", [(200_000, False), (50, True)])
def test_a_batch_of_many_rows_is_not_broadcast(spark, database, tmp_path, monkeypatch, rows, broadcast):
    from tidemark.sinks import tables as sinks

    plans = []

    def seen(function):
        def run(*args):
            df = function(*args)
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return df
        return run

    for name in ("update_matched", "unmatched", "touched_values"):
        monkeypatch.setattr(sinks, name, seen(getattr(sinks, name)))
    held = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("p"), F.lit("old").alias("v"))
    table = new_table(spark, database, held, PartitionRule.parse(None, "p"))
    spark.range(rows).select(F.col("id").alias("k"), (F.col("id") % 3).alias("p"), F.lit("new").alias("v")).write.parquet(f"file:{tmp_path}/batch")
    table.merge(spark.read.parquet(f"file:{tmp_path}/batch"), ["k"])
    assert len(plans) == 3 and [("BroadcastHashJoin" in p) for p in plans] == [broadcast] * 3
    assert table.read().where("v = 'new'").count() == rows and table.read().count() == max(rows, 1000)


def test_partitioned_writes_do_not_sort(spark, database, orders, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    table = new_table(spark, database, orders, PartitionRule.parse("years", "o_orderdate"))
    plan = lambda: spark.sql(f"EXPLAIN INSERT INTO {table.name} SELECT * FROM {table.name}").first()[0]
    assert "Sort" in plan()
    plans, parquet, insert = [], DataFrameWriter.parquet, DataFrameWriter.insertInto
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *args: (plans.append(plan()), parquet(*args))[1])
    monkeypatch.setattr(DataFrameWriter, "insertInto", lambda *args: (plans.append(plan()), insert(*args))[1])
    table.merge(orders.withColumn("o_orderkey", F.col("o_orderkey") + 7), ["o_orderkey"])
    table.append(orders.limit(1))
    assert len(plans) == 3 and "Sort" not in "".join(plans)
    assert "Sort" in plan()  # the session is as it was
    # one task with more partitions than it has files open
    rows = spark.range(1000).select("id", F.pmod(F.xxhash64("id"), F.lit(100)).alias("p")).coalesce(1)
    many = ParquetTable(spark, database, "many", PartitionRule.parse(None, "p"))
    many.publish_new(many.stage(rows, rebalance=False))
    assert values(many.read()) == values(rows) and len(many._partition_specs()) == len(spark.table(many.name).inputFiles()) == 100


@pytest.mark.parametrize("column", [None, "p"])
def test_a_file_has_a_bounded_number_of_rows(spark, database, monkeypatch, column):
    from tidemark.sinks import tables as sinks

    monkeypatch.setattr(sinks, "_FILE_ROWS", 100)
    rows = spark.range(1000).select("id", (F.col("id") % 2).alias("p")).coalesce(1)
    table = new_table(spark, database, rows, PartitionRule.parse(None, column) if column else None)
    assert len(spark.table(table.name).inputFiles()) == 10 and values(table.read(), "id", "p") == values(rows)


def test_many_partitions_are_published_in_seconds(spark, database):
    import time

    table = ParquetTable(spark, database, "many", PartitionRule.parse(None, "p"))
    rows = spark.range(400).select("id", F.col("id").cast("string").alias("p"))
    table.publish_new(table.stage(rows))
    staged = table.stage(rows)
    start = time.monotonic()
    table.publish_partitions(staged)
    assert time.monotonic() - start < 60 and table.read().count() == 400


# --- partitions by several columns ----------------------------------------

BY_TWO = "days(at), status"
FOUR = ("id", "at", "status", "text")


def _notices(spark, rows):
    return spark.createDataFrame(rows, "id int, at timestamp_ntz, status string, text string")


def _day(n):
    return dt.datetime(2024, 1, n, 5)


def test_partitionings_as_text():
    assert PartitionRules.parse("days(sent_at), email_status").names == ["sent_at_day", "email_status"]
    assert PartitionRules.parse("bucket(16, k), years(`a, b`), `x y`").names == ["k_bucket", "a, b_year", "x y"]
    assert PartitionRules.parse("hours(ts)") == PartitionRule("hour", "ts") and PartitionRules.parse(" ") is None
    for bad in ("nonsense(x)", "bucket(0, k)", "days(at), days(at)"):
        with pytest.raises(ValueError):
            PartitionRules.parse(bad)


def test_a_table_by_two_columns_is_written_overwritten_and_merged(spark, database):
    table = ParquetTable(spark, database, "notices", PartitionRules.parse(BY_TWO))
    rows = [(1, _day(1), "SENT", "a"), (2, _day(1), "FAILED", "b"), (3, _day(2), "SENT", "c"), (4, _day(2), "a/b =%", "d"), (5, None, None, "e"), (6, _day(3), None, "f")]
    table.publish_new(table.stage(_notices(spark, rows)))
    again = ParquetTable(spark, database, "notices")
    assert again.partition == PartitionRules.parse(BY_TWO)
    assert values(again.read(), *FOUR) == values(_notices(spark, rows), *FOUR)
    assert len(again._partition_specs()) == 6

    files = {r[0]: r[1] for r in spark.table(table.name).select("id", F.col("_metadata.file_path")).collect()}
    again.publish_partitions(again.stage(_notices(spark, [(7, _day(1), "SENT", "new")])))  # only this pair of values
    rows = [(7, _day(1), "SENT", "new"), *rows[1:]]
    assert values(again.read(), *FOUR) == values(_notices(spark, rows), *FOUR)
    now = {r[0]: r[1] for r in spark.table(table.name).select("id", F.col("_metadata.file_path")).collect()}
    assert {k: f for k, f in files.items() if k != 1} == {k: f for k, f in now.items() if k != 7}

    # rows move from one pair to another, one pair is emptied, two get a row
    again.merge(_notices(spark, [(2, _day(2), "SENT", "moved"), (8, _day(9), "SENT", "x"), (6, _day(3), None, "F")]), ["id"])
    rows = [(7, _day(1), "SENT", "new"), (2, _day(2), "SENT", "moved"), (3, _day(2), "SENT", "c"), (4, _day(2), "a/b =%", "d"), (5, None, None, "e"),
            (6, _day(3), None, "F"), (8, _day(9), "SENT", "x")]
    assert values(again.read(), *FOUR) == values(_notices(spark, rows), *FOUR)
    assert "at_day=2024-01-01/status=FAILED" not in again._partition_specs()
    after = {r[0]: r[1] for r in spark.table(table.name).select("id", F.col("_metadata.file_path")).collect()}
    assert {k: now[k] for k in (7, 4, 5)} == {k: after[k] for k in (7, 4, 5)}  # not touched, so not rewritten

    again.publish_append(again.stage(_notices(spark, [(9, _day(1), "SENT", "more"), (10, _day(20), "SENT", "day")])))
    assert again.read().count() == 9
    again.publish_replace(again.stage(_notices(spark, rows[:2])))
    assert values(again.read(), *FOUR) == values(_notices(spark, rows[:2]), *FOUR) and len(again._partition_specs()) == 2


def test_a_scan_of_a_table_by_two_columns_prunes_both(spark, database):
    table = ParquetTable(spark, database, "notices", PartitionRules.parse(BY_TWO))
    table.publish_new(table.stage(_notices(spark, [(k, _day(1 + k % 20), f"S{k % 3}", "t") for k in range(100)])))
    out = tables.scan(spark, table.name, ["id", "at", "status"], Watermark("at", "2024-01-15 05:00:00"), table.partition).where("status = 'S1'")
    plan = out._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "at_day" in filters and "status" in filters
    assert {r.id for r in out.collect()} == {k for k in range(100) if k % 20 > 14 and k % 3 == 1}


def test_maintenance_of_a_table_by_two_columns(spark, database):
    table = ParquetTable(spark, database, "notices", PartitionRules.parse(BY_TWO))
    rows = _notices(spark, [(k, _day(1 + k % 2) if k % 7 else None, ["x/y", None][k % 2], "t") for k in range(60)])
    table.publish_new(table.stage(rows.repartition(12), rebalance=False))
    parts = len(table._partition_specs())
    assert len(spark.table(table.name).inputFiles()) > parts
    assert maintenance.compact(table) > 0
    assert len(spark.table(table.name).inputFiles()) == parts and values(table.read(), *FOUR) == values(rows, *FOUR)
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(days=9)
    assert maintenance.remove_orphans(table, now=later) > 0 and values(table.read(), *FOUR) == values(rows, *FOUR)


def test_compaction_is_one_job_for_many_partitions(spark, database):
    table = ParquetTable(spark, database, "many", PartitionRule("identity", "p"))
    table.publish_new(table.stage(spark.range(4000).selectExpr("id", "cast(id % 400 AS int) AS p").repartition(4), rebalance=False))
    assert len(spark.table(table.name).inputFiles()) > 1200
    spark.sparkContext.setJobGroup("compaction", "compaction")
    plan = maintenance.compaction_plan(maintenance.table_files(table)).where("rewrite").select("partition", "files", "target_files").collect()
    spark.sparkContext.setJobGroup("rewrite", "rewrite")
    staged = maintenance._rewrite_partitions(table, plan, 128)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("rewrite")
    spark.sparkContext.setJobGroup("", "")
    stages = {s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
    assert len(plan) == 400 and len(jobs) <= 8 and len(stages) < 30  # listings, parts of one adaptive query, and its write
    table.publish_partitions(staged)
    assert len(spark.table(table.name).inputFiles()) == 400 and table.read().count() == 4000


def test_compaction_keeps_the_order_of_rows(spark, database):
    table = ParquetTable(spark, database, "sorted", PartitionRule("identity", "p"))
    table.publish_new(table.stage(spark.range(6000).selectExpr("id", "1 AS p").repartitionByRange(6, "id").sortWithinPartitions("id"), rebalance=False))
    size = sum(r["file_size"] for r in maintenance.table_files(table).collect())
    assert maintenance.compact(table, size / 2 / 1024 / 1024) == 6
    files = spark.table(table.name).select("id", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("r")).collect()
    by_file = {}
    for row in sorted(files, key=lambda x: (x.f, x.r)):
        by_file.setdefault(row.f, []).append(row.id)
    assert 2 <= len(by_file) <= 3 and all(ids == list(range(ids[0], ids[0] + len(ids))) for ids in by_file.values())
