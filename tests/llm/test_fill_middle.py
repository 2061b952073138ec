import hashlib
import re

import pytest

from samples import docs, empty, nothing  # noqa: F401
from tidemark.llm import fill_middle


def brute(name, text, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digest = len(units), hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    one, two, three, four = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or three % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((one % (n + 1), two % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if four % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def name(x):
    return "" if x is None else x


def order(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    lines = ["", "\n", "\n\n", "a", "a\n", "a\nb", "é\n中\n😀x\n", "a<P>b\nc", "x<S>", "<M>", "<P", "<\nP>\n<\nS", "a\r\nb c\n", None,
             "\n".join(f"line {k} ü" for k in range(30_000)), "ä" * 300_000 + "\nend\n" + "<S" * 5, "one\ntwo\nthree\n" * 40]
    rows = [(k, t, "clash") for k, t in enumerate(lines)] + [(None, "no\nid\nhere\n", "x")] + [(5, "same\nrow\ntwice\n", "x")] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)


@pytest.mark.parametrize("options", [{}, {"rate": 40}, {"spm": 0, "seed": 3}])
@pytest.mark.parametrize("table", ["odd", "docs"])
def test_digests(table, options, request):
    table = request.getfixturevalue(table)
    want = []
    for r in table.collect():
        *own, output = brute(name(r.doc_id), r.text, **options)
        want.append((r.doc_id, *own, sha(output), sha(r.text or "")))
    assert order(map(tuple, fill_middle.digests(table, **options).collect())) == order(want)


def test_outputs_and_restored_texts(odd):
    pieces = fill_middle.transform(odd)
    rows = odd.collect()
    assert order(map(tuple, fill_middle.texts(pieces).collect())) == order((r.doc_id, *brute(name(r.doc_id), r.text)) for r in rows)
    restored = fill_middle.texts(fill_middle.restore(pieces)).collect()
    assert order((r.id, r.text) for r in restored) == order((r.doc_id, r.text or "") for r in rows)


def test_pieces_are_bounded(odd):
    sizes = [len(r.data) for r in fill_middle.transform(odd).select("data").collect()]
    assert max(sizes) <= fill_middle.PIECE + 3 and len(sizes) > 19


def test_marks_across_pieces():
    whole = b"<P>a<b<S>tail<M>mid<"
    for size in range(1, 8):
        apart, out = fill_middle._Apart("psm"), dict.fromkeys(fill_middle.PARTS, b"")
        for data in [*(whole[k:k + size] for k in range(0, len(whole), size)), None]:
            for part, cut in apart.feed(data):
                if cut:
                    out[part] += cut
        assert out == {"prefix": b"a<b", "suffix": b"tail", "middle": b"mid<"}


def test_an_output_without_its_marks_is_an_error():
    with pytest.raises(ValueError):
        list(fill_middle._Apart("psm").feed(b"x<P>"))
    with pytest.raises(ValueError):
        list(fill_middle._Apart("spm").feed(None))


def test_empty_and_other_ids(spark, nothing):
    assert fill_middle.digests(nothing).collect() == []
    named = spark.createDataFrame([("k", "a\nb\n")], "doc_id string, text string")
    *own, output = brute("k", "a\nb\n")
    assert [tuple(r) for r in fill_middle.digests(named).collect()] == [("k", *own, sha(output), sha("a\nb\n"))]
