import base64
import gzip
import hashlib

import pytest

from samples import empty, nothing  # noqa: F401
from tidemark.llm import archives
from tidemark.llm.folders import folder


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


BODIES = [None, "", "a", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "http://x 0.0.0.0 20240101000000 text/html 5\nhello\n", "\n\n\n", "é中😀\x00", "x" * 300_000]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://h.example/{k}", BODIES[k % len(BODIES)], "clash") for k in range(40)]
    rows += [(100, None, "only here", ""), (101, "  ", "and here\r\n", ""), (102, "http://h/a b\nc\x7f", "spaces", None), (None, "http://n/", "a", ""), (None, "http://n/", "none", ""),
             (7, "http://h/7", "x" * 300_000, "again"), (50, "http://h/rep", "twice", ""), (50, "http://h/rep", "twice", "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, path string").repartition(3)


def brute(rows, least=0):
    """page id, bytes, digest, type, refers to."""
    bodies = [(r.page_id, (r.html or "").encode()) for r in rows]
    first, out = {}, []
    for key, body in sorted(bodies, key=lambda x: (x[0] is None, x[0] or 0)):
        again = len(body) >= least and body in first
        out.append((key, len(body), b32(body), "revisit" if again else "response", first[body] if again else None))
        first.setdefault(body, key)
    return sorted(out, key=repr)


def result(spark, pages, least=0, **options):
    home = folder(spark, "archives")
    archives.write_arc(pages, f"{home}/arc", **options)
    archives.convert(spark, f"{home}/arc", f"{home}/warc", least=least)
    read = archives.read_warc(spark, f"{home}/warc", payloads=True).where("record_type <> 'warcinfo'")
    return home, read


def shown(read):
    cast = read.selectExpr("cast(key AS long)", "payload_bytes", "payload_digest", "record_type", "cast(refers_to AS long)")
    return sorted(map(tuple, cast.collect()), key=repr)


@pytest.mark.parametrize("version", [None, 1, 2])
@pytest.mark.parametrize("least", [0, 3])
def test_against_brute_force(spark, pages, version, least, monkeypatch):
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", 400_000)
    rows = pages.collect()
    home, read = result(spark, pages, least, version=version)
    assert shown(read) == brute(rows, least)
    stored = sorted((r.payload for r in read.where("record_type = 'response'").collect()))
    again = {b for b in map(lambda r: (r.html or "").encode(), rows)}
    assert set(stored) == again and (least or len(stored) == len(again))
    kinds = {r.version for r in archives.read_arc(spark, f"{home}/arc").select("version").distinct().collect()}
    assert kinds == ({version} if version else {1, 2})


def test_identifiers_dates_and_urls(spark, pages):
    _, read = result(spark, pages)
    rows = read.collect()
    ids = {r.record_id: r for r in rows}
    assert len(ids) == len(rows) and all(r.date == "2024-01-01T00:00:00Z" for r in rows)
    for r in rows:
        if r.record_type == "revisit":
            assert ids[r.refers_to_id].key == r.refers_to and ids[r.refers_to_id].payload_digest == r.payload_digest
    assert {r.url for r in rows if r.key in ("100", "101", "102")} == {"unknown:", "http://h/a%20b%0Ac%7F"}


def test_files_are_plain_gzip_warc(spark, pages):
    home, _ = result(spark, pages)
    for row in spark.read.format("binaryFile").load(f"{home}/warc").collect():
        text = gzip.decompress(bytes(row.content))
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and text.endswith(b"\r\n\r\n")




def arc(version, *records):
    fields = archives.ARC_FIELDS[version]
    block = f"{version} 0 Archive\n{fields}\n\n".encode()
    more = b"200 - - 0 a.arc " if version == 2 else b""
    out = b"filedesc://a.arc 1.2.3.4 19960923142103 text/plain " + more + f"{len(block)}\n".encode() + block + b"\n"
    for url, date, mime, body in records:
        out += f"{url} 1.2.3.4 {date} {mime} ".encode() + more + f"{len(body)}\n".encode() + body + b"\n"
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_legacy_files(version):
    page = b"HTTP/1.0 200 OK\nContent-Type: text/html\n\n<p>\nfiledesc://x 1 2 3 4\n"
    data = arc(version, ("http://a b/ c", "20010203040506", "text/html", page), ("dns:a.b", "2001", "text/dns", b"20010203\na.b. 1 IN A 1.2.3.4"),
               ("http://late/", "no-date", "text/html", b"\xff\xfe"), ("ftp://f/x", "20019999000000", "text/plain", b""))
    for content in (data, gzip.compress(data), gzip.compress(data[:200]) + gzip.compress(data[200:])):
        desc, a, dns, late, ftp = archives.arc_records("x", content)
        assert desc.url == "filedesc://a.arc" and desc.version == version
        assert (a.url, a.date, a.parts()[1]) == ("http://a b/ c", "20010203040506", b"<p>\nfiledesc://x 1 2 3 4\n")
        assert dns.http is False and archives._warc_date(dns.date) == "2001-01-01T00:00:00Z"
        assert late.block == b"\xff\xfe" and not late.http and ftp.block == b""
        out = archives._converted(dns, "x", None)
        (back,) = archives.warc_records("y", out + b"\r\n\r\n")
        assert back.fields["warc-type"] == "resource" and back.block == dns.block
        assert back.fields["content-type"] == "text/dns" and back.fields["warc-ip-address"] == "1.2.3.4"


@pytest.mark.parametrize("broken", [
    arc(1, ("http://a/", "20010203040506", "text/html", b"abc"))[:-3], b"http://a/ 1 20010203 text/html 3\nabc\n",
    arc(1).replace(b"1 0 Archive", b"7 0 Archive"), arc(1) + b"http://a/ 1.2.3.4 20010203 text/html many\n", arc(1) + b"one two\n"])
def test_broken_archives_are_errors(broken):
    with pytest.raises(archives.ArchiveError, match="x, at"):
        list(archives.arc_records("x", broken))


def test_a_changed_payload_is_noticed(spark, pages, tmp_path):
    record = archives._converted(archives.Record(0, "http://a/", "", "2001", "text/html", b"HTTP/1.1 200 OK\r\n\r\nhello", 1), "x", None)
    (tmp_path / "a.warc").write_bytes(record.replace(b"hello", b"jello") + b"\r\n\r\n")
    with pytest.raises(Exception, match="digest"):
        archives.read_warc(spark, f"file:{tmp_path}").collect()


def test_bytes_that_are_no_text_survive(spark, tmp_path):
    body = bytes(range(256)) * 3
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "a.arc").write_bytes(arc(1, ("http://a/", "20010203040506", "image/png", b"HTTP/1.1 200 OK\r\n\r\n" + body)))
    archives.convert(spark, f"file:{tmp_path}/arc", f"file:{tmp_path}/warc")
    rows = archives.read_warc(spark, f"file:{tmp_path}/warc", payloads=True).where("record_type = 'response'").collect()
    assert [bytes(r.payload) for r in rows] == [body] and rows[0].payload_digest == b32(body)


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    _, read = result(spark, none)
    assert read.collect() == []
