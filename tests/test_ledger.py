import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from tidemark.operators import ledger
from tidemark.operators.watermark import advance, batch_high, newer_than, start_value
from tidemark.functions.partitioning import PartitionRule
from tidemark.functions.types import verdict, watermark_literal
from tidemark.sinks.ledgers import FileAudit, NotificationAudit, RunLedger, WatermarkStore
from pyspark.sql import types as T

DAY = dt.date(2024, 1, 15)


@pytest.fixture(scope="module")
def runs():
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 14)
    return [(f"r{i}", f"j{rnd.randint(0, 9)}", start + dt.timedelta(minutes=rnd.randint(0, 4320)),
             rnd.choice(["SUCCESS", "FAILED"])) for i in range(60)]


@pytest.fixture
def frame(spark, runs):
    return spark.createDataFrame(runs, "run_id string, job_id string, start_time timestamp, status string")


def test_daily_queries_match_brute_force(frame, runs):
    today = [r for r in runs if r[2].date() == DAY]
    failed = {j for _, j, _, s in today if s == "FAILED"}
    done = {j for _, j, _, s in today if s == "SUCCESS"}
    assert {r["job_id"] for r in ledger.failed_jobs(frame, DAY).collect()} == failed
    assert {r["job_id"] for r in ledger.succeeded_jobs(frame, DAY).collect()} == done
    assert {r["job_id"] for r in ledger.jobs_to_run(frame, frame, DAY).collect()} == {r[1] for r in runs} - done
    rerun = {j for _, j, t, s in today if s == "FAILED"
             and not any(j2 == j and s2 == "SUCCESS" and t2 > t for _, j2, t2, s2 in today)}
    assert {r["job_id"] for r in ledger.unrecovered_jobs(frame, DAY).collect()} == rerun
    assert ledger.failed_runs(frame, DAY).count() == sum(s == "FAILED" for *_, s in today)


def test_search_and_facets(spark):
    df = spark.createDataFrame([("Orders", "pg", True), ("Invoices", "N/A", True), (None, "pg", False)], "name string, engine string, on boolean")
    assert values(ledger.search(df, {"engine": "pg"}, "ORD", ["name", "engine"]), "name") == [("Orders",)]
    assert ledger.search(df, {"on": True}).count() == 2
    assert ledger.search(df, {}, "  ", ["name"]).count() == 3
    assert [r[0] for r in ledger.facets(df, "engine").collect()] == ["pg"]


def test_routing(spark):
    df = spark.createDataFrame([("FAILED",), (" success",), ("SLA_BREACHED",), ("odd",)], "status string")
    rules = [ledger.RoutingRule("ON_FAILURE"), ledger.RoutingRule("on_success", enabled=False)]
    assert values(ledger.route(df, rules), "event", "rule") == [
        ("odd", None), ("on_failure", "on_failure"), ("on_sla_breach", None), ("on_success", None)]
    assert {r["rule"] for r in ledger.route(df, [], ["x@y"]).collect()} == {"default"}


def test_dependencies(spark):
    tasks = spark.createDataFrame([("a", []), ("b", ["a"]), ("c", ["a", "zz"])], "task_id string, depends_on array<string>")
    assert values(ledger.task_edges(tasks)) == [("b", "a"), ("c", "a"), ("c", "zz")]
    assert values(ledger.missing_dependencies(tasks)) == [("c", "zz")]
    overrides = spark.createDataFrame([("c", ["b"]), ("a", [])], "task_id string, depends_on array<string>")
    assert values(ledger.task_edges(ledger.with_overrides(tasks, overrides))) == [("b", "a"), ("c", "b")]


def test_missing_feeds(spark):
    listing = spark.createDataFrame([("inv_20240101.csv",), ("x.xlsx",)], "file_name string")
    assert values(ledger.missing_feeds(listing, [("inv", "inv_*.csv"), ("pay", "pay_*.csv"), ("x", "x.xls?")])) == [("pay", "pay_*.csv")]


def test_count_drop_uses_only_earlier_days(spark):
    days = [("j", dt.date(2024, 1, d), 100) for d in range(1, 9)] + [("j", dt.date(2024, 1, 9), 90), ("k", dt.date(2024, 1, 9), 1)]
    daily = spark.createDataFrame(days, "job string, day date, n long")
    assert values(ledger.drops(daily, "job", 3), "job", "day") == [("j", dt.date(2024, 1, 9))]


def test_watermark_rules():
    assert advance("5", None) == "5" and advance("5", "9") == "9" and advance(None, None) is None
    assert start_value(None, None) == "1970-01-01 00:00:00"
    assert start_value(None, "7", "numeric") == "7" and start_value("8", "7", "numeric") == "8"
    assert start_value(None, None, "numeric") is None


def test_watermark_filter_is_strict_typed_and_pushed(spark, orders):
    first = orders.agg(F.min("o_orderdate").cast("string")).first()[0]
    out = newer_than(orders, "O_ORDERDATE", first)
    assert out.count() == orders.where(F.col("o_orderdate") > F.lit(first).cast("timestamp_ntz")).count() < orders.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan
    assert newer_than(orders, "o_orderdate", None) is orders
    assert newer_than(orders, "o_orderkey", "100", "numeric").count() == orders.where("o_orderkey > 100").count()
    with pytest.raises(ValueError):
        newer_than(orders, "o_orderkey", "100", "timestamp")
    assert batch_high(out.where("false"), "o_orderdate").first()[0] is None
    with pytest.raises(ValueError):
        watermark_literal("1", T.LongType(), "other")


@pytest.mark.parametrize("kind", ["days", "hours", "months", "years", None])
def test_implied_partition_predicate_loses_nothing(spark, kind):
    df = spark.range(3000).select(F.expr("timestamp_ntz'2023-11-30 22:00:00' + make_dt_interval(0, id)").alias("ts"))
    rule = PartitionRule.parse(kind, "ts")
    stored = rule.add_to(df)
    for value in ("2023-12-31 23:30:00", "2024-01-31 00:00:00", "2022-01-01 00:00:00"):
        assert newer_than(stored, "ts", value, partition=rule).count() == newer_than(df, "ts", value).count()


@pytest.mark.parametrize("source,target,expected", [
    ("int", "bigint", "widen"), ("bigint", "int", "conflict"), ("smallint", "bigint", "widen"),
    ("float", "double", "widen"), ("int", "double", "conflict"), ("string", "int", "conflict"),
    ("decimal(10,2)", "decimal(18,2)", "widen"), ("decimal(18,2)", "decimal(18,4)", "conflict"),
    ("interval day to second", "bigint", "conflict"), ("string", "string", "same"),
])
def test_type_lattice(spark, source, target, expected):
    assert verdict(T.DataType.fromDDL(source), T.DataType.fromDDL(target)) == expected


def test_watermark_store_keeps_jobs_apart(spark, database):
    store = WatermarkStore(spark, database)
    assert store.get("customer_load") is None
    store.put("customer_load", "2026-08-10 10:00:00")
    store.put("account_load", "2026-08-10 10:05:00")
    store.put("customer_load", "2026-08-11 00:00:00")
    store.put("sftp_file::/a b/c=d.csv", "12_x")
    assert store.get("customer_load") == "2026-08-11 00:00:00"
    assert store.get("account_load") == "2026-08-10 10:05:00"
    assert store.get("sftp_file::/a b/c=d.csv") == "12_x"
    assert store.current().count() == 3
    for empty in ("", "  ", None):
        with pytest.raises(ValueError):
            store.put("customer_load", empty)
    # A new catalog entry over the same folder finds the state again.
    spark.sql(f"DROP TABLE {store.ledger.name}")
    assert WatermarkStore(spark, database).get("customer_load") == "2026-08-11 00:00:00"


def test_run_ledger_records_success_and_failure(spark, database):
    book = RunLedger(spark, database)
    run = {"run_id": "r1", "job_id": "j", "start_time": dt.datetime(2024, 1, 15, 1), "end_time": dt.datetime(2024, 1, 15, 1, 0, 2)}
    book.record(run | {"rows_read": 5, "rows_written": 5})
    book.record(run | {"run_id": "r2"}, KeyError("boom"))
    rows = {r["run_id"]: r for r in book.read().collect()}
    assert rows["r1"]["status"] == "SUCCESS" and rows["r1"]["duration_seconds"] == 2.0
    assert rows["r1"]["start_time"] == dt.datetime(2024, 1, 15, 1)
    assert rows["r2"]["status"] == "FAILED" and rows["r2"]["error_type"] == "KeyError" and "boom" in rows["r2"]["error_trace"]
    assert book.since(dt.date(2024, 1, 16)).count() == 0
    plan = book.since(DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(commit_day" in plan
    columns = spark.table(book.name).columns
    assert columns[:11] == ["run_id", "job_id", "source_type", "target_table", "start_time", "end_time",
                            "duration_seconds", "rows_read", "rows_written", "status", "error_message"]


def test_notification_audit_has_fourteen_columns(spark, database):
    book = NotificationAudit(spark, database)
    book.record({"job_id": "j", "event_type": "on_failure", "email_status": "NO_RECIPIENTS"})
    assert len(book.read().columns) == 14 and book.read().first()["job_id"] == "j"


def test_concurrent_commits_do_not_disturb_each_other(spark, database):
    from concurrent.futures import ThreadPoolExecutor

    book = RunLedger(spark, database)
    book.ensure()
    start = dt.datetime(2024, 1, 15)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: book.record({"run_id": f"r{i}", "job_id": "j", "start_time": start}), range(16)))
    assert book.read().count() == 16


def test_file_audit(spark, database):
    listing = spark.createDataFrame([("a.csv", "/x/a.csv", 10, "t1", None)],
                                    "file_name string, file_path string, file_size long, last_modified string, file_owner string")
    audit = FileAudit(spark, database)
    audit.record(listing, spark.createDataFrame([("/x/a.csv", 3)], "file_path string, record_count long"), "db.t")
    audit.record(listing, spark.createDataFrame([], "file_path string, record_count long"), "db.u", "FAILED", "bad")
    assert len(audit.read().columns) == 10
    assert values(audit.loaded("db.t")) == [("/x/a.csv", 10, "t1")]
    assert audit.loaded("db.u").count() == 0


def test_roll_up_keeps_rows_and_open_days(spark, database):
    from tidemark.sinks.ledgers import RunLedger, WatermarkStore

    store = WatermarkStore(spark, database)
    for k in range(4):
        store.put("a/b=c job", str(k))
    store.put("other", "x")
    before = values(store.ledger.read())
    assert store.ledger.roll_up(keep=["a/b=c job"]) == 0 and store.ledger.roll_up() == 3
    assert values(store.ledger.read()) == before and store.get("a/b=c job") == "3"
    store.put("a/b=c job", "4")
    assert store.get("a/b=c job") == "4" and store.ledger.roll_up() == 1
    ledger_ = RunLedger(spark, database)
    for k in range(3):
        ledger_.record({"run_id": str(k), "job_id": "j", "start_time": dt.datetime(2024, 1, 1)})
    today = dt.datetime.now(dt.timezone.utc).date()
    assert ledger_.roll_up(keep=[today]) == 0 and ledger_.roll_up() == 2 and ledger_.read().count() == 3


def test_a_day_without_rows_is_a_drop(spark):
    rows = [("j", dt.date(2024, 1, d), 100) for d in range(1, 15) if d != 9]
    daily = spark.createDataFrame(rows, "job string, day date, n long")
    assert dt.date(2024, 1, 9) in [d for _, d in values(ledger.drops(daily, "job", 3), "job", "day")]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("method, calls", [("_place", 0), ("_place", 1), ("_attach", 0), ("detach", 1), ("detach", 2)])
def test_a_roll_up_that_stops_changes_no_count(spark, database, monkeypatch, method, calls):
    """It stops before, while or after the merged commits are placed, attached, and the others
    detached (the first detach is the one of an earlier stop); the next one finishes it."""
    from tidemark.sinks.ledgers import Ledger

    book = Ledger(spark, database, "book", "k bigint, kind string", "kind", "string")
    for n in range(3):
        for kind in ("a", "b c/d"):
            book.append(spark.range(n + 1).select(F.col("id").alias("k")), kind)
    before = values(book.read())
    assert len(before) == 12
    done, whole, failed = [], getattr(Ledger, method), []

    def stops(self, *args):
        done.append(1)
        if len(done) > calls and not failed:
            failed.append(1)
            raise Stopped
        return whole(self, *args)

    with monkeypatch.context() as patched:
        patched.setattr(Ledger, method, stops)
        try:
            book.roll_up()
        except Stopped:
            pass
    assert values(book.read()) == before
    # another catalog over the folder sees the same, whatever was left there
    spark.sql(f"DROP TABLE {book.name}")
    assert values(book.read()) == before
    book.roll_up()
    assert values(book.read()) == before and sorted(len(c) for c in book.commits().values()) == [1, 1]
    assert book.roll_up() == 0 and values(book.read()) == before
    book.append(spark.range(5).select(F.col("id").alias("k")), "a")
    assert book.roll_up() == 1 and book.read().count() == 17
    spark.sql(f"DROP TABLE {book.name}")
    assert book.read().count() == 17  # merged commits of merged commits, and all that they replace, are there again


def test_a_commit_that_was_not_finished_is_not_found(spark, database):
    from tidemark.sinks.ledgers import Ledger

    book = Ledger(spark, database, "book", "k bigint, kind string", "kind", "string")
    book.append(spark.range(2).select(F.col("id").alias("k")), "a")
    spark.range(3).select(F.col("id").alias("k")).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{book.root}/kind=a/commit_id=c-half")
    spark.sql(f"DROP TABLE {book.name}")
    assert book.read().count() == 2


def test_an_older_ledger_gets_the_column(spark, database):
    from tidemark.sinks.ledgers import Ledger

    book = Ledger(spark, database, "book", "k bigint, kind string", "kind", "string")
    spark.sql(f"CREATE TABLE {book.name} (k BIGINT, kind STRING, commit_id STRING) USING parquet PARTITIONED BY (kind, commit_id) LOCATION '{book.root}'")
    for n in range(2):
        book.append(spark.range(2).select(F.col("id").alias("k")), "a")
    assert book.roll_up() == 1 and book.read().count() == 4


def test_a_roll_up_reads_closed_commits_only(spark, database):
    store = WatermarkStore(spark, database)
    for k in range(3):
        store.put("a", str(k))
        store.put("b", str(k))
    store.ledger.roll_up()
    plan = store.history("a")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("StartsWith") and plan.count("= a") >= 2  # the job's folders on both sides of the anti-join


# --- runs that have not ended ---------------------------------------------

def _signals(spark, rows):
    return spark.createDataFrame([(j, r, s, dt.datetime(2024, 1, 1, h, m)) for j, r, s, h, m in rows], "job_id string, run_id string, signal string, at timestamp_ntz")


def test_open_runs_are_overdue_or_silent(spark):
    rows = [
        ("a", "done", "START", 1, 0), ("a", "done", "END", 1, 5),
        ("a", "quiet", "START", 8, 0), ("a", "quiet", "BEAT", 8, 10), ("a", "quiet", "BEAT", 8, 10),
        ("a", "long", "START", 6, 0), ("a", "long", "BEAT", 9, 55), ("a", "late end", "START", 9, 50), ("a", "late end", "END", 10, 5),
        ("b", "both", "START", 2, 0), ("b", "young", "START", 9, 58),
        ("b", "resumed", "START", 3, 0), ("b", "resumed", "END", 3, 10), ("b", "resumed", "START", 9, 57), ("b", "resumed", "BEAT", 9, 59),
        ("c", "no start", "BEAT", 9, 0), ("c", "only end", "END", 9, 0), (None, "no job", "START", 1, 0)]
    moment = dt.datetime(2024, 1, 1, 10, 0)
    limits = spark.createDataFrame([("a", 3 * 3600.0), ("a", 9 * 3600.0), ("b", 3600.0), (None, 60.0)], "job_id string, limit_seconds double")
    found = {(r.job_id, r.run_id): (r.reason, r.open_seconds, r.silent_seconds) for r in ledger.open_runs(_signals(spark, rows), moment, limits, 1800).collect()}
    assert found == {
        ("a", "quiet"): ("SILENT", 7200.0, 6600.0), ("a", "long"): ("OVERDUE", 4 * 3600.0, 300.0), ("b", "both"): ("OVERDUE,SILENT", 8 * 3600.0, 8 * 3600.0),
        ("b", "resumed"): ("OVERDUE", 7 * 3600.0, 60.0), ("c", "no start"): ("SILENT", 3600.0, 3600.0), (None, "no job"): ("OVERDUE,SILENT", 9 * 3600.0, 9 * 3600.0)}
    # one limit for all, and none at all
    assert ledger.open_runs(_signals(spark, rows), moment, 5 * 3600).count() == 3
    assert ledger.open_runs(_signals(spark, rows), moment).count() == 0
    assert ledger.open_runs(_signals(spark, []), moment, 1, 1).count() == 0
    spans = {r.run_id: (r.end_time, r.last_seen, r.beats) for r in ledger.run_intervals(_signals(spark, rows), moment).collect()}
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    assert spans["late end"] == (None, at(9, 50), 0)  # not known to have ended yet
    assert spans["done"] == (at(1, 5), at(1, 0), 0) and spans["only end"] == (at(9, 0), at(9, 0), 0) and spans["quiet"] == (None, at(8, 10), 2)


def test_open_runs_take_one_shuffle(spark):
    rows = [("a", str(k % 50), "START", 1, k % 60) for k in range(500)]
    plan = ledger.open_runs(_signals(spark, rows), dt.datetime(2024, 1, 2), 60, 60)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan


def test_a_load_leaves_signals(spark, database):
    from tidemark import LoadSpec, run_load
    from tidemark.operators.quality import QualityError
    from tidemark.sinks.ledgers import RunSignals

    def spec(**sections):
        return LoadSpec.from_dict({
            "task": {"task_id": "j", "task_name": "j", "signals": True}, "source": {"type": "table", "connection": "c", "schema": "s", "table": "t"},
            "load": {"type": "full"}, "target": {"type": "parquet", "catalog": "spark_catalog", "database": database, "table": "t"},
            "preload": {"enabled": False}, "postload": {"enabled": False}, "audit_columns": {"enabled": False}, **sections})

    run_load(spark, spec(), batch=spark.range(3), state_database=database, run_id="one")
    with pytest.raises(QualityError):
        run_load(spark, spec(data_quality={"minimum_rows": 9}), batch=spark.range(3), state_database=database, run_id="two", force=True)
    book = RunSignals(spark, database)
    assert values(book.read().select("run_id", "signal", "step")) == [
        ("one", "BEAT", "published"), ("one", "BEAT", "staged"), ("one", "END", "done"), ("one", "START", ""), ("two", "END", "failed"), ("two", "START", "")]
    book.record("j", "dead", ledger.START, at=dt.datetime(2024, 1, 1))
    assert [r.run_id for r in ledger.open_runs(book.read(), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), 3600).collect()] == ["dead"]


def test_file_state_snapshots(spark, database):
    """A load reads the snapshot and the days after it; of a rewritten file the last fingerprint counts."""
    columns = "file_name string, file_path string, file_size long, last_modified string, file_owner string"
    audit = FileAudit(spark, database)

    def loaded(path, size, day, status="SUCCESS", target="db.t"):
        listing = spark.createDataFrame([(path, path, size, f"m{size}", None)], columns)
        audit.record(listing, spark.createDataFrame([(path, 1)], "file_path string, record_count long"), target, status, at=dt.datetime(2024, 1, day, 5))

    loaded("/a", 1, 1)
    loaded("/b", 2, 1)
    loaded("/a", 3, 2)  # rewritten
    loaded("/c", 4, 2, "FAILED")
    loaded("/x", 9, 2, target="db.u")
    loaded("/d", 5, 3)
    before = values(audit.loaded("db.t"))
    assert before == [("/a", 1, "m1"), ("/a", 3, "m3"), ("/b", 2, "m2"), ("/d", 5, "m5")]
    audit.snapshot("db.t", dt.date(2024, 1, 3))
    want = [("/a", 3, "m3"), ("/b", 2, "m2"), ("/d", 5, "m5")]
    assert values(audit.loaded("db.t")) == want and values(audit.loaded("db.u")) == [("/x", 9, "m9")]
    files = audit.loaded("db.t").inputFiles()
    assert not any("commit_day=2024-01-01" in f or "commit_day=2024-01-02" in f for f in files)
    audit.snapshot("db.t", dt.date(2024, 1, 2))  # older than what there is: nothing happens
    assert values(audit.loaded("db.t")) == want
    loaded("/b", 6, 4)
    audit.snapshot("db.t", dt.date(2024, 1, 5))
    assert values(audit.loaded("db.t")) == [("/a", 3, "m3"), ("/b", 6, "m6"), ("/d", 5, "m5")]
    assert len(audit._state.commits()["db.t"]) == 1
