import pytest

from tidemark.plans import hooks
from tidemark.plans.spec import LoadSpec, SpecError, substitute_env

TOML = """
[task]
task_id = "customer"
task_name = "Customer load"
depends_on = "a, b"

[source]
type = "oracle"
connection = "${CONN:oracle_prod}"
schema = "BANK"
table = "CUSTOMER"

[source.extraction]
columns = ["CUSTOMER_ID", "UPDATED_AT"]
exclude = "SSN"

[source.jdbc]
split_column = "CUSTOMER_ID"
num_partitions = -3
fetch_size = "many"
lower_bound = "7"
upper_bound = "x"

[load]
type = "UPSERT"
[load.incremental]
column = "UPDATED_AT"
watermark_type = "odd"
[load.options]
initial_watermark = "2020-01-01 00:00:00"
preserve = "dwh_insert_ts"

[keys]
primary_key = "CUSTOMER_ID"
merge_keys = ["CUSTOMER_ID"]

[target]
catalog = "hive"
database = "edw_bronze"
table = "customer"
[target.partition]
type = "days"
column = "updated_at"
[target.maintenance]
target_file_size_mb = "x"
orphan_file_retention_days = 9

[transform]
exclude = "TMP"
[transform.rename]
CUSTOMER_ID = "customer_id"

[audit]
insert_timestamp = "ins"
timezone = "UTC"

[quality]
null_check = ["CUSTOMER_ID"]
minimum_rows = "oops"

[email_notification]
enabled = true
to = "a@x, b@x"
[email_notification.events.on_success]
enabled = false
to = ["c@x"]
"""


def test_every_section(tmp_path):
    (tmp_path / "s.toml").write_text(TOML)
    spec = LoadSpec.from_toml(tmp_path / "s.toml", {})
    assert spec.task.depends_on == ("a", "b") and spec.task.enabled
    assert spec.source.connection == "oracle_prod" and spec.source.exclude == ("SSN",)
    jdbc = spec.source.jdbc
    assert (jdbc.partition_column, jdbc.num_partitions, jdbc.fetch_size, jdbc.lower_bound, jdbc.upper_bound) == (
        "CUSTOMER_ID", 4, 10000, "7", None)
    load = spec.load
    assert (load.type, load.watermark_column, load.watermark_type) == ("upsert", "UPDATED_AT", "timestamp")
    # keys from [keys] do not lose the load's options
    assert load.merge_keys == ("CUSTOMER_ID",) and load.initial_watermark == "2020-01-01 00:00:00"
    assert load.preserve == ("dwh_insert_ts",)
    assert spec.target.partition.kind == "day" and spec.target.full_name == "hive.edw_bronze.customer"
    assert spec.target.maintenance.target_file_size_mb == 128 and spec.target.maintenance.orphan_file_retention_days == 9
    assert spec.audit.insert_ts == "ins" and spec.audit.timezone == "UTC" and spec.audit.run_id == "dwh_etl_run_id"
    assert spec.quality.null_check == ("CUSTOMER_ID",) and spec.quality.minimum_rows == 0
    assert spec.notify.recipients == ("a@x", "b@x") and spec.notify.rules[0].event == "on_success"
    assert spec.postload.operations == ("update_watermark", "compact_table")


def minimal(**changes):
    data = {
        "task": {"task_id": "t", "task_name": "t"},
        "source": {"type": "mysql", "connection": "c", "schema": "s", "table": "t"},
        "load": {"type": "full"},
        "target": {"catalog": "hive", "database": "d", "table": "t"},
    }
    for name, value in changes.items():
        data[name] = value if not isinstance(value, dict) else {**data.get(name, {}), **value}
    return data


@pytest.mark.parametrize("changes", [
    {"task": None}, {"task": {"task_id": ""}}, {"task": {"task_name": " "}}, {"task": {"enabled": "perhaps"}},
    {"source": {"type": "db2"}}, {"source": {"connection": ""}}, {"source": {"table": 5}}, {"source": {"jdbc": 3}},
    {"load": {"type": "weekly"}}, {"load": {"type": "incremental"}}, {"load": {"type": "upsert", "watermark_column": "u"}},
    {"load": {"options": {"overwrite": "some"}}}, {"target": {"catalog": ""}}, {"target": {"type": "csv"}},
])
def test_invalid_specs(changes):
    with pytest.raises(SpecError):
        LoadSpec.from_dict(minimal(**changes))


def test_missing_sections_and_files(tmp_path):
    for name in ("source", "load", "target"):
        data = minimal()
        del data[name]
        with pytest.raises(SpecError):
            LoadSpec.from_dict(data)
    with pytest.raises(SpecError):
        LoadSpec.from_toml(tmp_path / "none.toml")
    (tmp_path / "bad.toml").write_text("[task")
    with pytest.raises(SpecError):
        LoadSpec.from_toml(tmp_path / "bad.toml")


def test_flat_forms_and_aliases():
    spec = LoadSpec.from_dict(minimal(
        source={"type": "sftp", "path": "/in", "file_pattern": "*.tsv", "delimiter": "\t"},
        jdbc={"partition_column": "k"}, job={}))
    assert (spec.source.feed.path, spec.source.feed.pattern, spec.source.feed.delimiter) == ("/in", "*.tsv", "\t")
    assert spec.source.jdbc.partition_column == "k"
    data = minimal(load={"type": "Incremental", "watermark_column": "u", "merge_key": "k"})
    data["job"] = {"job_id": "j", "job_name": "J"}
    del data["task"]
    spec = LoadSpec.from_dict(data)
    assert spec.task.id == "j" and spec.load.watermark_column == "u" and spec.load.merge_keys == ("k",)
    # the primary key stands in for the merge keys of an upsert
    spec = LoadSpec.from_dict(minimal(load={"type": "upsert", "watermark_column": "u"}, keys={"primary_key": ["a", "b"]}))
    assert spec.load.merge_keys == ("a", "b")


def test_bucket_partition_text():
    spec = LoadSpec.from_dict(minimal(target={"partition": {"type": "bucket(8, ID)"}}))
    assert (spec.target.partition.kind, spec.target.partition.buckets, spec.target.partition.column) == ("bucket", 8, "ID")


def test_environment_is_substituted_recursively():
    env = {"A": "1"}
    assert substitute_env({"x": ["${A}", {"y": "${B:2}-${C}"}], "n": 5}, env) == {"x": ["1", {"y": "2-"}], "n": 5}


def test_unknown_operations_stop_before_any_runs():
    hooks.verify_names(LoadSpec.from_dict(minimal()))
    for stage in ("preload", "postload"):
        bad = LoadSpec.from_dict(minimal(**{stage: {"operations": ["refresh_metadata", "drop_table"]}}))
        with pytest.raises(SpecError, match="drop_table"):
            hooks.verify_names(bad)
        hooks.verify_names(LoadSpec.from_dict(minimal(**{stage: {"enabled": False, "operations": ["drop_table"]}})))


def test_what_a_full_load_replaces():
    plain = LoadSpec.from_dict(minimal(target={"partition": {"type": "days", "column": "d"}}))
    assert plain.target.replaces_all(plain.load)
    feed = LoadSpec.from_dict(minimal(source={"type": "sftp", "path": "/in"}, target={"partition": {"type": "days", "column": "d"}}))
    assert feed.target.replaces_all(feed.load)
    forced = LoadSpec.from_dict(minimal(load={"options": {"overwrite": "partitions"}}))
    assert not forced.target.replaces_all(forced.load)


def test_flags_given_as_text():
    spec = LoadSpec.from_dict(minimal(postload={"enabled": "${GATE:false}"}, task={"enabled": "TRUE"}), env={})
    assert not spec.postload.enabled and spec.task.enabled
    with pytest.raises(SpecError):
        LoadSpec.from_dict(minimal(data_quality={"enabled": "sometimes"}))
    with pytest.raises(SpecError):
        LoadSpec.from_dict(minimal(source={"type": "sftp", "path": "/in", "file_format": "xlsx"}))
    with pytest.raises(SpecError):
        LoadSpec.from_dict(minimal(aggregate={"keys": ["k"]}))
