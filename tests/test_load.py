import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import values
from tidemark import LoadSpec, dry_run, run_load
from tidemark.operators.quality import QualityError
from tidemark.operators.schema import SchemaError
from tidemark.plans.load import LoadFailed
from tidemark.plans.spec import SpecError
from tidemark.sinks.ledgers import FileAudit, NotificationAudit, RunLedger, WatermarkStore
from tidemark.operators.watermark import Watermark
from tidemark.sinks.tables import ParquetTable
from tidemark.sources import tables


def make(database, load=None, **sections):
    data = {
        "task": {"task_id": "job", "task_name": "Job"},
        "source": {"type": "table", "connection": "c", "schema": database, "table": "src"},
        "load": load or {"type": "full"},
        "target": {"type": "parquet", "catalog": "spark_catalog", "database": database, "table": "t"},
        "audit_columns": {"enabled": False}, "preload": {"enabled": False}, "postload": {"enabled": False},
    }
    for name, value in sections.items():
        data[name] = {**data.get(name, {}), **value}
    return LoadSpec.from_dict(data)


def target(spark, database):
    return ParquetTable(spark, database, "t")


def state(spark, database):
    """Everything a failed load must not change."""
    table = target(spark, database)
    files = sorted(spark.table(table.name).inputFiles()) if table.exists() else None
    return files, WatermarkStore(spark, database).get("job"), values(FileAudit(spark, database).loaded())


def test_skip_disabled_force_and_dry_run(spark, database, customer):
    spec = make(database)
    assert run_load(spark, make(database, task={"enabled": False}), batch=customer, state_database=database).status == "DISABLED"
    schema = dry_run(spark, make(database, transform={"rename": {"c_custkey": "id"}}), batch=customer, state_database=database)
    assert schema.names[0] == "id" and not target(spark, database).exists()
    first = run_load(spark, spec, batch=customer, state_database=database)
    assert (first.status, first.rows_read, first.rows_written) == ("SUCCESS", customer.count(), customer.count())
    assert run_load(spark, spec, batch=customer, state_database=database).status == "SKIPPED"
    assert run_load(spark, spec, batch=customer, state_database=database, force=True).status == "SUCCESS"
    assert values(target(spark, database).read()) == values(customer)
    assert RunLedger(spark, database).read().where("status = 'SUCCESS' AND rows_read > 0 AND duration_seconds > 0").count() == 2


def test_reads_a_catalog_table_incrementally_with_partition_pruning(spark, database, orders):
    source = ParquetTable(spark, database, "src", make(database, target={"partition": {"type": "years", "column": "o_orderdate"}}).target.partition)
    source.publish_new(source.stage(orders))
    spec = make(database, {"type": "incremental", "incremental": {"column": "o_orderdate"},
                           "options": {"initial_watermark": "2000-06-01 00:00:00"}})
    result = run_load(spark, spec, state_database=database)
    expected = orders.where("o_orderdate > timestamp_ntz'2000-06-01'")
    assert result.rows_read == expected.count() and values(target(spark, database).read()) == values(expected)
    assert result.watermark == expected.agg(F.max("o_orderdate").cast("string")).first()[0]


def test_incremental_append_then_empty_batch(spark, database, orders):
    spec = make(database, {"type": "incremental", "incremental": {"column": "O_ORDERDATE"}})
    half = orders.where("o_orderdate < timestamp_ntz'1998-01-01'")
    run_load(spark, spec, batch=half, state_database=database)
    run_load(spark, spec, batch=orders, state_database=database, force=True)
    mark = WatermarkStore(spark, database).get("job")
    again = run_load(spark, spec, batch=orders, state_database=database, force=True)
    assert (again.rows_read, again.watermark) == (0, mark) == (0, WatermarkStore(spark, database).get("job"))
    assert values(target(spark, database).read()) == values(orders)


@pytest.mark.parametrize("partition", [{}, {"type": "years", "column": "o_orderdate"}])
def test_empty_batches(spark, database, orders, partition):
    spec = make(database, target={"partition": partition})
    none = orders.where("o_orderkey < 0")
    run_load(spark, spec, batch=none, state_database=database)
    assert target(spark, database).read().count() == 0
    run_load(spark, spec, batch=orders, state_database=database, force=True)
    files = sorted(spark.table(target(spark, database).name).inputFiles())
    keyed = make(database, keys={"merge_keys": ["o_orderkey"]}, target={"partition": partition})
    run_load(spark, keyed, batch=none, state_database=database, force=True)
    assert sorted(spark.table(target(spark, database).name).inputFiles()) == files  # nothing rewritten
    run_load(spark, spec, batch=none, state_database=database, force=True)
    assert target(spark, database).read().count() == 0  # a full load of nothing


def test_upsert_takes_the_newest_row_and_keeps_insert_values(spark, database):
    schema = "K int, v string, AT timestamp_ntz, ins string"
    day = lambda n: dt.datetime(2024, 1, n)
    spec = make(
        database, {"type": "upsert", "incremental": {"column": "AT"}, "options": {"preserve": ["ins"]}},
        keys={"merge_keys": ["K"]}, transform={"rename": {"K": "key", "AT": "seen"}},
        target={"partition": {"type": "days", "column": "seen"}})
    first = spark.createDataFrame([(1, "a", day(1), "r1"), (2, "b", day(1), "r1"), (1, "a2", day(2), "r1")], schema)
    run_load(spark, spec, batch=first, state_database=database)
    second = spark.createDataFrame([(1, "late", day(2), "r2"), (2, "b2", day(3), "r2"), (3, "c", day(3), "r2")], schema)
    result = run_load(spark, spec, batch=second, state_database=database, force=True)
    assert result.rows_read == 2  # the row at the watermark is not read again
    assert values(target(spark, database).read(), "key", "v", "seen", "ins") == [
        (1, "a2", day(2), "r1"), (2, "b2", day(3), "r1"), (3, "c", day(3), "r2")]


@pytest.mark.parametrize("quality", [
    {"minimum_rows": 10**9}, {"null_check": ["note"]}, {"unique_check": ["O_CUSTKEY"]},
])
def test_a_failed_gate_changes_nothing(spark, database, orders, quality):
    load = {"type": "incremental", "incremental": {"column": "o_orderdate"}}
    noted = orders.withColumn("note", F.expr("nullif(o_orderstatus, 'F')"))
    run_load(spark, make(database, load), batch=orders.where("o_orderdate < timestamp_ntz'1998-01-01'"), state_database=database)
    before = state(spark, database)
    notify = {"enabled": True, "to": "ops@x", "events": [{"event": "on_quality_failure", "to": "dq@x", "template": "t"}]}
    with pytest.raises(QualityError):
        run_load(spark, make(database, load, data_quality=quality, email_notification=notify), batch=noted, state_database=database, force=True)
    assert state(spark, database) == before
    assert "note" not in target(spark, database).schema().names
    failed = RunLedger(spark, database).read().where("status = 'FAILED'").first()
    assert failed["error_type"] == "QualityError"
    notice = NotificationAudit(spark, database).read().first()
    assert (notice["event_type"], notice["recipients_to"], notice["email_status"]) == ("on_quality_failure", "dq@x", "NOT_SENT")


def test_merge_gate_defaults(spark, database):
    keyed = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    with pytest.raises(QualityError, match="null_check"):
        run_load(spark, make(database, keys={"merge_keys": ["k"]}), batch=keyed, state_database=database)
    doubled = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(QualityError, match="unique_check"):
        run_load(spark, make(database, keys={"merge_keys": ["k"]}), batch=doubled, state_database=database)
    lenient = make(database, keys={"merge_keys": ["k"]}, data_quality={"check_null_keys": False, "check_duplicate_keys": True})
    run_load(spark, lenient, batch=keyed, state_database=database)
    run_load(spark, lenient, batch=keyed, state_database=database, force=True)
    assert values(target(spark, database).read()) == [(None, "b"), (None, "b"), (1, "a")]  # NULL keys never match


def test_primary_key_is_checked_on_request(spark, database):
    doubled = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    keys = {"primary_key": ["k"]}
    assert run_load(spark, make(database, keys=keys), batch=doubled, state_database=database).rows_read == 2
    with pytest.raises(QualityError, match="unique_check"):
        run_load(spark, make(database, keys=keys, data_quality={"check_duplicate_keys": True}), batch=doubled, state_database=database, force=True)


def test_dry_run_of_a_feed_leaves_no_trace(spark, database, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("ID,NAME\n1,ann\n")
    spec = feed_spec(database, folder)
    before = {t.name for t in spark.catalog.listTables(database)}
    assert dry_run(spark, spec, state_database=database).names[:2] == ["ID", "NAME"]
    incremental = make(database, {"type": "incremental", "incremental": {"column": "k"}})
    dry_run(spark, incremental, batch=spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "k timestamp"), state_database=database)
    assert {t.name for t in spark.catalog.listTables(database)} == before == set()


def test_schema_evolution_and_refusal(spark, database, customer):
    run_load(spark, make(database), batch=customer.select("c_custkey"), state_database=database)
    with pytest.raises(SchemaError):
        run_load(spark, make(database, schema={"evolution": False}), batch=customer, state_database=database, force=True)
    with pytest.raises(SchemaError):
        run_load(spark, make(database), batch=customer.select(F.col("c_custkey").cast("string")), state_database=database, force=True)
    run_load(spark, make(database), batch=customer, state_database=database, force=True)
    assert values(target(spark, database).read(), *customer.columns) == values(customer)
    narrow = customer.select(F.col("c_custkey").cast("int"))
    run_load(spark, make(database), batch=narrow, state_database=database, force=True)
    assert values(target(spark, database).read(), "c_custkey", "c_name") == sorted((r[0], None) for r in narrow.collect())


def test_hooks_run_in_order_and_report(spark, database, orders):
    spec = make(
        database, {"type": "incremental", "incremental": {"column": "o_orderdate"}},
        preload={"enabled": True, "operations": ["check_watermark", "validate_source", "validate_target"]},
        postload={"enabled": True, "operations": ["compact_table", "refresh_metadata", "update_watermark",
                                                  "remove_orphan_files", "expire_snapshots"]})
    result = run_load(spark, spec, batch=orders.repartition(10), state_database=database)
    assert list(result.hooks) == ["check_watermark", "validate_source", "validate_target", "compact_table",
                                  "refresh_metadata", "update_watermark", "remove_orphan_files", "expire_snapshots"]
    assert result.hooks["check_watermark"] is None and result.hooks["validate_target"] is False
    assert result.hooks["compact_table"] == 10 and len(spark.table(target(spark, database).name).inputFiles()) == 1
    assert result.hooks["update_watermark"] == result.watermark
    off = make(database, postload={"enabled": True, "operations": ["compact_small_files", "cleanup_orphan_files"]},
               target={"maintenance": {"enabled": False}})
    assert set(run_load(spark, off, batch=orders, state_database=database, force=True).hooks.values()) == {"off"}
    with pytest.raises(SpecError):
        run_load(spark, make(database, postload={"enabled": True, "operations": ["what"]}), batch=orders, state_database=database)


def feed_spec(database, folder, **source):
    return make(database, source={"type": "sftp", "path": f"file:{folder}", "file_pattern": "*.csv", "columns_ddl": "ID int, NAME string", **source},
                target={"partition": {"type": "days", "column": "dwh_insert_ts"}}, audit_columns={"enabled": True, "timezone": "UTC"})


def test_feed_loads_new_files_once(spark, database, tmp_path):
    folder = tmp_path / "in dir"
    spec = feed_spec(database, folder)
    assert run_load(spark, spec, state_database=database).status == "NO_DATA"  # no such folder
    folder.mkdir()
    assert run_load(spark, spec, state_database=database, force=True).status == "NO_DATA"
    (folder / "a+1.csv").write_text("ID,NAME\n1,ann\n2,bob\n")
    run = lambda day: run_load(spark, spec, state_database=database, force=True, as_of=dt.datetime(2024, 1, day))
    assert run(1).rows_read == 2
    (folder / "b.csv").write_text("NAME,ID\ncid,3\n")
    assert run(2).rows_read == 3  # a full load replaces rows, so it reads all files
    table = target(spark, database)
    assert values(table.read(), "ID", "NAME") == [(1, "ann"), (2, "bob"), (3, "cid")]
    assert "__source_file" not in table.read().columns and "__corrupt_record" not in table.read().columns
    audit = FileAudit(spark, database).read()
    assert values(audit, "file_name", "record_count", "status") == [("a+1.csv", 2, "SUCCESS"), ("a+1.csv", 2, "SUCCESS"), ("b.csv", 1, "SUCCESS")]
    added = make(database, {"type": "incremental", "incremental": {"column": "ID", "watermark_type": "numeric"}}, source=spec.raw["source"],
                 target={"table": "added"})
    assert run_load(spark, added, state_database=database, force=True).rows_read == 3
    assert run_load(spark, added, state_database=database, force=True).status == "NO_DATA"
    (folder / "c.csv").write_text("NAME,ID\ndee,4\n")
    assert run_load(spark, added, state_database=database, force=True).rows_read == 1


def test_no_files_run_the_gate_and_do_not_end_the_day(spark, database, tmp_path):
    spec = feed_spec(database, tmp_path)
    assert run_load(spark, spec, state_database=database).status == "NO_DATA"
    assert RunLedger(spark, database).read().first()["status"] == "NO_DATA"
    with pytest.raises(QualityError):
        run_load(spark, LoadSpec.from_dict({**spec.raw, "data_quality": {"minimum_rows": 1}}), state_database=database)
    (tmp_path / "a.csv").write_text("ID,NAME\n1,ann\n")
    assert run_load(spark, spec, state_database=database).rows_read == 1
    assert run_load(spark, spec, state_database=database).status == "SKIPPED"


def test_only_the_named_catalog_and_format(spark, database, customer):
    for changes in ({"type": "iceberg"}, {"catalog": "hive_prod"}):
        with pytest.raises(SpecError):
            run_load(spark, make(database, target=changes), batch=customer, state_database=database)


def test_only_utc_sessions(spark, database, orders):
    zone = spark.conf.get("spark.sql.session.timeZone")
    source = ParquetTable(spark, database, "zoned", make(database, target={"partition": {"type": "days", "column": "at"}}).target.partition)
    rows = spark.sql("SELECT id, timestamp'2024-01-01 20:00:00' + make_interval(0, 0, 0, 0, id) AS at FROM range(12)")
    source.publish_new(source.stage(rows))
    mark = Watermark("at", "2024-01-02 00:30:00")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Dhaka")
        with pytest.raises(ValueError):
            run_load(spark, make(database), batch=orders, state_database=database)
        with pytest.raises(ValueError):
            source.stage(rows)
        plain = spark.table(source.name)
        assert values(tables.scan(spark, source.name, ["id"], mark, source.partition)) == values(mark.newer(plain).select("id"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    with pytest.raises(ValueError):
        Watermark("k", "9", "numeric").newer(spark.createDataFrame([("9",), ("10",)], "k string"))


def test_dropped_rows_are_reported(spark, database):
    spec = make(database, {"type": "upsert", "incremental": {"column": "at", "watermark_type": "numeric"}}, keys={"merge_keys": ["k"]})
    result = run_load(spark, spec, batch=spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, at int"), state_database=database)
    assert (result.rows_read, result.rows_written, result.rows_dropped) == (3, 2, 1)


def test_specs_of_one_job_id_do_not_skip_each_other(spark, database, customer):
    run = lambda path: run_load(spark, make(database), batch=customer, state_database=database, config_path=path).status
    assert [run("/a/one.toml"), run("/b/one.toml"), run("/a/two.toml")] == ["SUCCESS", "SKIPPED", "SUCCESS"]


def test_a_bad_file_fails_the_feed_and_is_audited(spark, database, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "good.csv").write_text("ID,NAME\n1,ann\n")
    (folder / "bad.csv").write_text("ID,NAME\nx,bob\n")
    before = state(spark, database)
    with pytest.raises(LoadFailed, match="bad.csv"):
        run_load(spark, feed_spec(database, folder), state_database=database)
    assert state(spark, database) == before
    failed = FileAudit(spark, database).read()
    assert values(failed, "file_name", "status", "record_count") == [("bad.csv", "FAILED", 0)]
    kept = run_load(spark, feed_spec(database, folder, bad_rows="keep"), state_database=database, force=True)
    assert kept.rows_read == 2


def test_a_failed_gate_leaves_the_files_new(spark, database, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("ID,NAME\n1,\n")
    spec = feed_spec(database, folder)
    strict = LoadSpec.from_dict({**spec.raw, "data_quality": {"null_check": ["name"]}})
    with pytest.raises(QualityError):
        run_load(spark, strict, state_database=database)
    assert FileAudit(spark, database).loaded().count() == 0
    assert run_load(spark, spec, state_database=database).rows_read == 1


def test_overlap_catches_late_rows(spark, database):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    load = {"type": "upsert", "incremental": {"column": "at"}, "options": {"overlap": "2 hours"}}
    spec = make(database, load, keys={"merge_keys": ["k"]})
    run = lambda rows: run_load(spark, spec, batch=spark.createDataFrame(rows, "k int, at timestamp_ntz"), state_database=database, force=True)
    run([(1, at(5)), (2, at(10))])
    result = run([(1, at(5)), (2, at(10)), (3, at(10)), (4, at(9)), (5, at(8))])
    assert result.rows_read == 3 and values(target(spark, database).read(), "k") == [(1,), (2,), (3,), (4,)]
    with pytest.raises(SpecError):
        make(database, {"type": "incremental", "incremental": {"column": "at"}, "options": {"overlap": "1 hour"}})


def test_files_arriving_during_a_load_stay_new(spark, database, tmp_path, monkeypatch):
    from tidemark.plans import load as module

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("ID,NAME\n1,ann\n")
    publish = module._publish

    def late(*arguments):
        (folder / "b.csv").write_text("ID,NAME\n2,bob\n")
        publish(*arguments)

    monkeypatch.setattr(module, "_publish", late)
    spec = LoadSpec.from_dict({**feed_spec(database, folder).raw, "load": {"type": "full", "options": {"overwrite": "partitions"}}})
    run = lambda day: run_load(spark, spec, state_database=database, force=True, as_of=dt.datetime(2024, 1, day))
    assert run(1).rows_read == 1
    assert values(FileAudit(spark, database).read(), "file_name") == [("a.csv",)]
    assert run(2).rows_read == 2
    assert values(target(spark, database).read(), "ID") == [(1,), (1,), (2,)]  # partitions are by day of load here


def test_slices_equal_one_load_under_any_cut(spark, database, orders):
    full = make(database, target={"table": "whole"})
    run_load(spark, full, batch=orders, state_database=database)
    load = {"type": "upsert", "incremental": {"column": "o_orderdate"}}
    spec = make(database, load, keys={"merge_keys": ["o_orderkey"]})
    for cut in ("1996-02-03", "1996-02-04", "1999-01-01", "2100-01-01"):
        run_load(spark, spec, batch=orders.where(F.col("o_orderdate") < F.lit(cut).cast("timestamp_ntz")), state_database=database, force=True)
    assert values(target(spark, database).read()) == values(ParquetTable(spark, database, "whole").read())


def test_the_source_is_read_once(spark, database, orders):
    """The staged batch serves count, gate, publish and watermark."""
    seen = spark.sparkContext.accumulator(0)

    def tap(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    tapped = orders.mapInPandas(tap, orders.schema)
    spec = make(database, {"type": "upsert", "incremental": {"column": "o_orderdate"}}, keys={"merge_keys": ["o_orderkey"]},
                data_quality={"null_check": ["o_custkey"], "unique_check": ["o_orderkey"], "minimum_rows": 1})
    run_load(spark, spec, batch=tapped, state_database=database)
    assert seen.value == orders.count()


# --- rows of the watermark's own value ------------------------------------

def _ties_spec(database, **options):
    return LoadSpec.from_dict({
        "task": {"task_id": "ties", "task_name": "ties"},
        "source": {"type": "table", "connection": "none", "schema": "none", "table": "none"},
        "load": {"type": "incremental", "incremental": {"column": "at"}, "options": options},
        "target": {"type": "parquet", "catalog": "spark_catalog", "database": database, "table": "ties"},
        "transform": {"rename": {"v": "value"}},
        "preload": {"enabled": False}, "postload": {"enabled": False},
    })


def _ties(spark, rows):
    return spark.createDataFrame(rows, "k int, at timestamp_ntz, v string")


def test_rows_of_the_last_value_that_come_late_are_loaded_once(spark, database):
    import datetime as dt

    one, two, three = (dt.datetime(2024, 1, d, 1, 2, 3, 456789) for d in (1, 2, 3))
    source = [(1, one, "a"), (2, two, None), (3, two, "x"), (3, two, "x")]
    target = ParquetTable(spark, database, "ties")

    def load(rows, **options):
        result = run_load(spark, _ties_spec(database, **options), batch=_ties(spark, rows), state_database=database, force=True)
        held = sorted(((r.k, r.at, r.value) for r in target.read().collect()), key=repr)
        assert held == sorted(rows, key=repr)
        return result.rows_read

    assert load(source) == 4
    assert load(source) == 0  # nothing new: every row at the value was there
    source += [(4, two, None), (3, two, "x"), (5, two, "a")]
    assert load(source) == 3  # one more copy of a row, and two others
    assert load(source) == 0
    source += [(6, three, "b"), (7, two, "with the old value")]
    assert load(source) == 2  # the value moves on and takes what came late along
    assert load(source) == 0
    source += [(8, three, "b")]
    assert load(source) == 1
    assert load(source) == 0


def test_ties_can_be_left_out(spark, database):
    import datetime as dt

    two = dt.datetime(2024, 1, 2)
    spec = _ties_spec(database, ties="lose")
    for rows in ([(1, two, "a")], [(1, two, "a"), (2, two, "b")]):
        run_load(spark, spec, batch=_ties(spark, rows), state_database=database, force=True)
    assert ParquetTable(spark, database, "ties").read().count() == 1


def test_a_boundary_without_its_watermark_changes_nothing(spark, database, monkeypatch):
    """The run stops between the two commits: the next one repeats the batch it has not recorded."""
    import datetime as dt
    from tidemark.sinks.ledgers import BoundaryStore, WatermarkStore

    one, two = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    run_load(spark, _ties_spec(database), batch=_ties(spark, [(1, one, "a")]), state_database=database, force=True)
    mark = WatermarkStore(spark, database).get("ties")
    BoundaryStore(spark, database).put("ties", "2024-01-02 00:00:00", BoundaryStore(spark, database).get("ties", mark)[0], ["k"])
    result = run_load(spark, _ties_spec(database), batch=_ties(spark, [(1, one, "a"), (2, two, "b")]), state_database=database, force=True)
    assert result.rows_read == 1 and ParquetTable(spark, database, "ties").read().count() == 2
    assert BoundaryStore(spark, database).get("ties", mark) is None  # what is past is detached


def test_a_column_added_later_does_not_repeat_rows(spark, database):
    import datetime as dt

    two = dt.datetime(2024, 1, 2)
    run_load(spark, _ties_spec(database), batch=_ties(spark, [(1, two, "a")]), state_database=database, force=True)
    wider = spark.createDataFrame([(1, two, "a", 9), (2, two, "b", 8)], "k int, at timestamp_ntz, v string, more int")
    assert run_load(spark, _ties_spec(database), batch=wider, state_database=database, force=True).rows_read == 1
    assert sorted((r.k, r.more) for r in ParquetTable(spark, database, "ties").read().collect()) == [(1, None), (2, 8)]


# --- rows that do not fit, set apart --------------------------------------

def _feed(database, path, load=None, **feed):
    return make(
        database, load, source={"type": "sftp", "path": f"file:{path}", "columns_ddl": "k BIGINT, at TIMESTAMP_NTZ, v STRING", "bad_rows": "quarantine", **feed})


def _rejected(spark, database):
    rows = spark.table(f"{database}.t_rejected").collect()
    return sorted((r.file_path.rsplit("/", 1)[-1], r.raw_text, r.reason) for r in rows)


def test_bad_rows_are_set_apart_with_their_reason(spark, database, tmp_path):
    (tmp_path / "a.csv").write_text("k,at,v\n1,2024-01-01 00:00:00,x\nq,2024-01-01 00:00:00,y\n2,never,z\n3,2024-01-02 00:00:00,w\n")
    (tmp_path / "b c.csv").write_text("v,k\n\"p,q\",4\nonly\nr,5,6\n")
    spec = _feed(database, tmp_path, {"type": "incremental", "incremental": {"column": "at"}}, bad_share=0.7)
    result = run_load(spark, spec, state_database=database)
    assert (result.rows_read, result.watermark) == (3, "2024-01-02 00:00:00")
    assert values(target(spark, database).read(), "k", "v") == [(1, "x"), (3, "w"), (4, "p,q")]
    assert _rejected(spark, database) == [
        ("a.csv", "2,never,z", "at: never is no timestamp_ntz"), ("a.csv", "q,2024-01-01 00:00:00,y", "k: q is no bigint"),
        ("b c.csv", "only", "fewer than 2 field(s), or an open quote"), ("b c.csv", "r,5,6", "more than 2 field(s)")]
    audited = FileAudit(spark, database).read().select("file_name", "status", "record_count")
    assert values(audited) == [("a.csv", "SUCCESS", 2), ("b c.csv", "SUCCESS", 1)]
    assert spark.table(f"{database}.t").columns == ["k", "at", "v"]
    # nothing is new, so nothing is added
    assert run_load(spark, spec, state_database=database, force=True).status == "NO_DATA"
    assert len(_rejected(spark, database)) == 4


@pytest.mark.parametrize("limits", [{"bad_share": 0.3}, {"bad_share": 1, "bad_limit": 1}])
def test_a_file_beyond_its_limit_is_left_out(spark, database, tmp_path, limits):
    good = "k,at,v\n" + "".join(f"{n},2024-01-0{1 + n % 3} 00:00:00,g\n" for n in range(5)) + "bad,2024-01-01 00:00:00,g\n"
    (tmp_path / "good.csv").write_text(good)
    (tmp_path / "bad.csv").write_text("k,at,v\n77,2025-01-01 00:00:00,b\nx,2024-01-01 00:00:00,b\ny,2024-01-01 00:00:00,b\n")
    load = {"type": "incremental", "incremental": {"column": "at"}}
    result = run_load(spark, _feed(database, tmp_path, load, **limits), state_database=database)
    assert (result.rows_read, result.watermark) == (5, "2024-01-03 00:00:00")  # of the accepted file alone
    assert target(spark, database).read().count() == 5
    assert [r[0] for r in _rejected(spark, database)] == ["bad.csv", "bad.csv", "good.csv"]
    audited = FileAudit(spark, database).read()
    assert values(audited.select("file_name", "status", "record_count")) == [("bad.csv", "FAILED", 0), ("good.csv", "SUCCESS", 5)]
    # mended, it is a new file
    (tmp_path / "bad.csv").write_text("k,at,v\n77,2025-01-01 00:00:00,b\n78,2024-01-01 00:00:00,b\n")
    assert run_load(spark, _feed(database, tmp_path, load, **limits), state_database=database, force=True).rows_read == 2
    assert target(spark, database).read().count() == 7


def test_a_full_load_with_a_refused_file_changes_nothing(spark, database, tmp_path):
    (tmp_path / "a.csv").write_text("k,at,v\n1,2024-01-01 00:00:00,x\n")
    run_load(spark, _feed(database, tmp_path), state_database=database)
    before = values(target(spark, database).read())
    (tmp_path / "b.csv").write_text("k,at,v\nx,2024-01-01 00:00:00,b\n")
    with pytest.raises(LoadFailed, match="b.csv"):
        run_load(spark, _feed(database, tmp_path), state_database=database, force=True)
    assert values(target(spark, database).read()) == before and not spark.catalog.tableExists(f"{database}.t_rejected")


def test_the_gate_sees_good_rows_only(spark, database, tmp_path):
    (tmp_path / "a.csv").write_text("k,at,v\n1,2024-01-01 00:00:00,x\n1x,2024-01-01 00:00:00,x\nbad,,\n")
    rules = {"null_check": ["k"], "unique_check": ["k"], "minimum_rows": 1}
    spec = make(database, source={"type": "sftp", "path": f"file:{tmp_path}", "columns_ddl": "k BIGINT, at TIMESTAMP_NTZ, v STRING",
                                  "bad_rows": "quarantine", "bad_share": 1}, data_quality=rules,
                target={"partition": {"by": "days(at), v"}})
    run_load(spark, spec, state_database=database)
    assert values(target(spark, database).read(), "k") == [(1,)] and len(_rejected(spark, database)) == 2
    with pytest.raises(SpecError):
        _feed(database, tmp_path, bad_rows="maybe")
    with pytest.raises(SpecError):
        _feed(database, tmp_path, bad_share=2)


def test_a_feed_of_bad_rows_alone(spark, database, tmp_path):
    (tmp_path / "a.csv").write_text("k,at,v\nx,2024-01-01 00:00:00,x\n")
    run_load(spark, _feed(database, tmp_path, bad_share=1), state_database=database)
    assert target(spark, database).read().count() == 0 and len(_rejected(spark, database)) == 1


def test_a_refused_load_leaves_the_rows_it_was_refused_for(spark, database):
    from tidemark.sinks.ledgers import QualitySamples

    nulls = spark.range(200).selectExpr("CASE WHEN id % 2 = 0 THEN id END AS k", "id AS n")
    twice = spark.range(10).selectExpr("id % 9 AS k", "id AS n")
    rules = {"null_check": ["k"], "unique_check": ["k"]}
    for batch in (nulls, twice, spark.range(3).selectExpr("id AS k", "id AS n")):
        try:
            run_load(spark, make(database, data_quality=rules), batch=batch, state_database=database, force=True, run_id=f"r{batch.count()}")
        except QualityError:
            pass
    found = QualitySamples(spark, database).read()
    assert found.where("rule = 'unique_check' and run_id = 'r200'").count() == 50  # NULLs are a group of equal keys
    assert values(found.where("rule = 'unique_check' and run_id <> 'r200'").select("run_id", "row")) == [("r10", '{"k":0,"n":0}'), ("r10", '{"k":0,"n":9}')]
    shown = [r.row for r in found.where("rule = 'null_check'").collect()]
    assert len(shown) == 50 and all('"k"' not in r for r in shown) and found.where("run_id = 'r3'").count() == 0
