import datetime as dt
import os

import pytest

from conftest import values
from tidemark.sources import feeds, markers
from tidemark.streaming import feeds as streams


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "sub dir").mkdir(parents=True)
    (tmp_path / "in" / "a.csv").write_text("ID,NAME\n1,ann\n2,bob\n")
    (tmp_path / "in" / "b.csv").write_text("NAME,ID,MOBILE\ncid,3,0171\n")
    (tmp_path / "in" / "sub dir" / "c+d.csv").write_text("ID,NAME\n4,\n")
    (tmp_path / "in" / "note.txt").write_text("no")
    return tmp_path / "in"


def scan(spark, folder, **options):
    listing = feeds.list_files(spark, f"file:{folder}", "*.csv")
    return feeds.csv_scan(spark, [r["file_path"] for r in listing.collect()], **options)


def test_listing_has_names_sizes_and_times(spark, folder):
    deep = feeds.list_files(spark, f"file:{folder}", "*.csv")
    assert values(deep, "file_name", "file_size") == [("a.csv", 20), ("b.csv", 26), ("c+d.csv", 11)]
    assert deep.where("file_owner is not null").count() == 0
    assert deep.first()["last_modified"].startswith(str(dt.datetime.now(dt.timezone.utc).year))
    flat = feeds.list_files(spark, f"file:{folder}", "*.csv", recursive=False)
    assert values(flat, "file_name") == [("a.csv",), ("b.csv",)]
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_union_by_name_over_layouts(spark, folder):
    declared = scan(spark, folder, schema="ID int, NAME string, MOBILE string")
    assert values(feeds.without_extras(declared)) == [(1, "ann", None), (2, "bob", None), (3, "cid", "0171"), (4, None, None)]
    inferred = feeds.without_extras(scan(spark, folder))
    assert dict(inferred.dtypes)["MOBILE"] == "int"  # inference loses the leading zero
    assert values(inferred, "ID", "NAME", "MOBILE") == [(1, "ann", None), (2, "bob", None), (3, "cid", 171), (4, None, None)]


def test_per_file_counts_and_corrupt_rows(spark, folder, tmp_path):
    (folder / "bad.csv").write_text("ID,NAME\n5,eve\nx,fay\n6,gus,extra\n")
    scan(spark, folder, schema="ID int, NAME string").write.parquet(f"{tmp_path}/stored")
    counts = feeds.file_counts(spark.read.parquet(f"{tmp_path}/stored"))
    found = {r["file_path"].rsplit("/", 1)[-1]: (r["record_count"], r["corrupt_count"]) for r in counts.collect()}
    assert {k.replace("%2B", "+"): v for k, v in found.items()} == {"a.csv": (2, 0), "b.csv": (1, 0), "c+d.csv": (1, 0), "bad.csv": (3, 2)}


def test_delimiter_encoding_and_no_header(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("1;Zoë\n2;Ær\n".encode("latin-1"))
    out = feeds.csv_scan(spark, [f"file:{tmp_path}/x.csv"], header=False, delimiter=";", encoding="ISO-8859-1", schema="k int, v string")
    assert values(feeds.without_extras(out)) == [(1, "Zoë"), (2, "Ær")]


def test_conflicting_types_become_text_whatever_the_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,x\n1,5\n")
    (tmp_path / "b.csv").write_text("k,x,y\n2,abc,1\n")
    for names in (("a", "b"), ("b", "a")):
        out = feeds.csv_scan(spark, [f"file:{tmp_path}/{n}.csv" for n in names])
        assert values(out, "k", "x") == [(1, "5"), (2, "abc")]


def test_no_files_is_an_empty_relation(spark):
    out = feeds.csv_scan(spark, [], schema="k int")
    assert out.count() == 0 and out.columns[0] == "k"
    with pytest.raises(ValueError):
        feeds.csv_scan(spark, [])


def test_new_files_by_fingerprint(spark, folder):
    listing = feeds.list_files(spark, f"file:{folder}", "*.csv")
    seen = listing.where("file_name <> 'b.csv'")
    rows = spark.createDataFrame(seen.collect(), seen.schema)
    assert values(feeds.new_files(listing, rows), "file_name") == [("b.csv",)]
    (folder / "a.csv").write_text("ID,NAME\n1,ann\n2,rob\n")  # same size, other time
    os.utime(folder / "a.csv", (1, 1))
    again = feeds.list_files(spark, f"file:{folder}", "*.csv")
    assert values(feeds.new_files(again, rows), "file_name") == [("a.csv",), ("b.csv",)]


def test_markers(spark, tmp_path):
    (tmp_path / "20240101").mkdir()
    (tmp_path / "20240101" / "a.toml_101010.txt").write_text(
        "SUCCESS RECORD TIMESTAMP: 2024-01-01T10:10:10.5+00:00\nJOB ID                 : job_a\n"
        "CONFIG PATH            : C:\\specs\\a.toml\nEXECUTION RUN ID       : run_1\nSTATUS                 : SUCCESS\n"
        "ROWS READ              : 250\nROWS WRITTEN           : 249\nDURATION (SECONDS)     : 1.85\n")
    (tmp_path / "20240101" / "b.toml_101011.txt").write_text(
        "FAILURE RECORD TIMESTAMP: 2024-01-01T10:10:11+00:00\nJOB ID                 : job_b\n"
        "CONFIG PATH            : /specs/b.toml\nERROR TYPE             : ConfigError\nERROR MESSAGE          : no: such thing\nTRACEBACK:\n...\n")
    out = markers.scan(spark, f"file:{tmp_path}")
    assert values(out, "job_id", "config_path", "run_id", "status", "rows_read", "duration_seconds", "error_message") == [
        ("job_a", "C:\\specs\\a.toml", "run_1", "SUCCESS", 250, 1.85, None),
        ("job_b", "/specs/b.toml", None, "FAILED", None, None, "no: such thing")]
    assert out.where("recorded_at = timestamp'2024-01-01 10:10:10.5'").count() == 1


def test_stream_takes_each_file_once(spark, folder, tmp_path):
    def run():
        stream = streams.read(spark, f"file:{folder}", "ID int, NAME string", pattern="a*.csv", options={"header": True})
        streams.ingest(stream, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").count()

    assert run() == 2 and run() == 2
    (folder / "a2.csv").write_text("ID,NAME\n9,zed\n")
    assert run() == 3


def test_stream_upsert_survives_out_of_order_files(spark, database, tmp_path):
    from tidemark.sinks.tables import ParquetTable

    for i, rows in enumerate(["1,new,5\n2,b,1\n", "1,old,4\n3,c,1\n", "2,b2,2\n"]):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.csv").write_text("k,v,at\n" + rows)
        os.utime(tmp_path / "in" / f"{i}.csv", (1000 + i, 1000 + i))
    table = ParquetTable(spark, database, "t")
    for _ in range(2):
        stream = streams.read(spark, f"file:{tmp_path}/in", "k int, v string, at int", files_per_batch=1, options={"header": True})
        streams.upsert(stream, table, ["k"], ["at"], f"{tmp_path}/check").awaitTermination()
    assert values(table.read()) == [(1, "new", 5), (2, "b2", 2), (3, "c", 1)]


def test_a_rewritten_file_replaces_its_rows_once(spark, database, tmp_path):
    from tidemark.streaming import rewrites

    source, state = tmp_path / "in", f"file:{tmp_path}/state"
    source.mkdir()
    table = rewrites.target(spark, database, "t", buckets=4)

    def run():
        rewrites.ingest(spark, f"file:{source}", "k int, v string", table, f"{state}/check", f"{state}/listings").awaitTermination()
        return values(table.read().select("k", "v"))

    (source / "a b.csv").write_text("k,v\n1,x\n2,y\n")
    (source / "c.csv").write_text("k,v\n3,z\n")
    assert run() == [(1, "x"), (2, "y"), (3, "z")]
    files = {f for f in spark.table(table.name).inputFiles()}
    assert run() == [(1, "x"), (2, "y"), (3, "z")] and {f for f in spark.table(table.name).inputFiles()} == files  # nothing has changed
    (source / "a b.csv").write_text("k,v\n2,new\n9,q\n")
    os.utime(source / "a b.csv", (2_000_000_000, 2_000_000_000))
    (source / "d.csv").write_text("k,v\n4,d\n")
    want = [(2, "new"), (3, "z"), (4, "d"), (9, "q")]
    assert run() == want and run() == want
    # the same batch again, as after a failure between publish and commit
    files = spark.createDataFrame([(f"file:{source}/a b.csv",)], f"{rewrites.FILE} string")
    rows = spark.createDataFrame([(2, "new", f"file:{source}/a b.csv"), (9, "q", f"file:{source}/a b.csv")], f"k int, v string, {rewrites.FILE} string")
    table.replace_by(files, rows, rewrites.FILE)
    assert values(table.read().select("k", "v")) == want
    # a file that becomes empty leaves no row
    (source / "c.csv").write_text("k,v\n")
    os.utime(source / "c.csv", (2_000_000_001, 2_000_000_001))
    assert run() == [(2, "new"), (4, "d"), (9, "q")]


def test_rows_are_replaced_in_an_unpartitioned_table(spark, database):
    from tidemark.sinks.tables import ParquetTable

    table = ParquetTable(spark, database, "t")
    rows = lambda *r: spark.createDataFrame(r, "f string, v int")
    table.publish_new(table.stage(rows(("a", 1), ("a", 2), ("b", 3), (None, 4))))
    for _ in range(2):
        table.replace_by(rows(("a", 0), ("c", 0), (None, 0)), rows(("a", 7)), "F")
        assert values(table.read()) == [(None, 4), ("a", 7), ("b", 3)]
    by_other = ParquetTable(spark, database, "u", None)
    assert by_other.exists() is False
