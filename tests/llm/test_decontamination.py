import random

import pytest

from samples import nothing, plain, words  # noqa: F401
from tidemark.llm.decontamination import contamination


def brute(rows, items, window=10):
    out = []
    kinds = []
    for item, text in items:
        w = plain(text)
        size = min(window, len(w))
        kinds += [(item, tuple(w[k:k + size])) for k in range(len(w) - size + 1) if w]
    for i, text in rows:
        w, hit, found = plain(text), set(), set()
        for item, g in kinds:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found.add(item)
        out.append((i, len(w), len(hit), sorted(x for x in found if x is not None)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    passage = words(rng, 30)
    items = [("1", " ".join(passage)), ("2", " ".join(passage[8:20])), ("3", "two words"), ("4", "Word, word; word!"), ("5", None), ("6", ""), ("1", " ".join(words(rng, 12))),
             (None, "nameless item"), ("7", "same " * 14), ("8", "ÉTÉ été")]
    rows = []
    for k in range(60):
        text = words(rng, rng.randint(0, 40))
        a = rng.randrange(25)
        text[rng.randint(0, len(text)):0] = passage[a:a + rng.choice([5, 9, 10, 11, 25])]
        if k % 5 == 0:
            text += ["two", "words"] * rng.randint(1, 3)
        rows.append((k, rng.choice([" ", "\n", ", "]).join(text)))
    rows += [(100, None), (101, ""), (102, "same " * 300), (103, "TWO WORDS"), (104, "a nameless item"), (105, "word word word"), (106, "été"), (0, rows[0][1]), (None, " ".join(passage))]
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], "doc_id long, text string, mark string, spans string, row string").repartition(3)
    return rows, items, docs, spark.createDataFrame(items, "item_id string, text string")


def got(df):
    return sorted(((r.id, r.n_words, r.n_hit, r["items"]) for r in df.collect()), key=str)


def test_agrees_with_brute_force(tables):
    rows, items, docs, benchmark = tables
    found = contamination(docs, benchmark)
    assert got(found) == brute(rows, items)
    for r in found.collect():
        assert sum(s["after"] - s["first"] for s in r.spans) == r.n_hit and all(a.after < b.first or a.after == b.first for a, b in zip(r.spans, r.spans[1:]))


def test_several_indexes_give_the_same(tables):
    rows, items, docs, benchmark = tables
    assert got(contamination(docs, benchmark, index_bytes=200)) == brute(rows, items)


def test_columns_are_carried(tables):
    rows, items, docs, benchmark = tables
    clean = contamination(docs, benchmark, carry=True).where("n_hit = 0").select("row.*")
    assert clean.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in clean.collect() if r.text) == sorted(
        (str(i), t) for i, t in rows if t and not brute([(i, t)], items)[0][2])


def test_empty_tables(spark, tables, nothing):
    _, _, docs, benchmark = tables
    assert contamination(nothing, benchmark).collect() == []
    assert all(r.n_hit == 0 and r["items"] == [] for r in contamination(docs, benchmark.limit(0)).collect())
