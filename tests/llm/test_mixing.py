from collections import defaultdict

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from samples import docs, nothing, shares, spaced  # noqa: F401
from tidemark.llm import mixing


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_shares_are_within_their_caps(sizes):
    out = shares(sizes)
    assert abs(sum(out) - sum(sizes)) < 1e-6 * max(1, sum(sizes))
    assert all(t <= 3 * n + 1e-9 for t, n in zip(out, sizes))
    free = [t / (k % 3 + 1) for k, (t, n) in enumerate(zip(out, sizes)) if t < 3 * n - 1e-6]
    assert not free or max(free) - min(free) < 1e-6 * max(1, max(free))


@pytest.mark.parametrize("sizes", [[0], [5], [0, 0, 0], [1, 1000, 3], [1000, 1, 1], [7, 0, 100, 3, 3, 900, 2, 1, 1], list(range(40)), [2**k for k in range(25)]])
def test_targets(spark, sizes):
    names = sorted([None if k == len(sizes) - 1 else f"s{k:03}" for k in range(len(sizes))], key=lambda s: (s is None, s or ""))
    sources = spark.createDataFrame(list(zip(names, sizes)), "source string, n long").repartition(3)
    found = {r.source: (r.n, r.target) for r in mixing.targets(sources, (1, 2, 3), 3).collect()}
    assert found == {s: (n, t) for s, n, t in zip(names, sizes, shares(sizes))}


def test_very_many_sources(spark):
    """None is a row on the driver; a tenth has most of the words."""
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('s', id) AS source", "repeat('w ', CASE WHEN id % 10 = 0 THEN 50 ELSE 1 END) AS text")
    out = mixing.mix(docs)
    assert out.count() == 30_000 and out.where("target > 3 * source_size + 1e-9 or copies > 3").count() == 0
    given_, wanted = out.agg(F.sum("target"), F.sum("size")).first()
    assert abs(given_ - wanted) < 1e-3


def check(rows, docs):
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert 0 <= r.copies <= 3 and r["size"] == len(spaced(docs[r.id])) if r.id in docs else True
        sizes[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
    wanted = dict(zip(order := sorted(sizes, key=lambda s: (s is None, s or "")), shares([sizes[s] for s in order])))
    assert wanted == target
    # rows of one id and text have one hash: at most two of them here
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1 for s in sizes)


def test_sources_come_near_their_targets(spark, docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    check(rows, {r.doc_id: r.text for r in docs.dropDuplicates(["doc_id"]).where("doc_id <> 20").collect()})
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda rows: sorted(map(str, rows))
    assert key(rows) == key(again)


def test_levels_do_not_change_the_result(spark, docs, monkeypatch):
    want = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "LEVEL_BITS", 20)
    assert sorted(map(str, mixing.mix(docs).collect())) == want


def test_larger_budgets_take_what_smaller_ones_take(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"), F.lit("a").alias("source"))
    sized = mixing._sized(rows, "doc_id", "text", "source")
    taken = []
    for budget in (100.0, 400.0, 900.0):
        limits = mixing._thresholds(sized, spark.createDataFrame([("a", budget)], "source string, budget double")).first()
        mine = sized.where((F.col("hash") < limits.below) | (F.col("hash") == F.lit(limits.edge)))
        taken.append({r.id for r in mine.collect()})
        assert abs(mine.agg(F.sum("size")).first()[0] - budget) <= 4
    assert taken[0] < taken[1] < taken[2]


def test_taken_repeats_rows(docs):
    copies = {(r.id, r["size"]): r.copies for r in mixing.mix(docs).collect()}
    out = mixing.taken(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(copies[r.doc_id, len(spaced(r.text))] for r in docs.collect())


def test_empty(nothing):
    assert mixing.mix(nothing).collect() == [] == mixing.taken(nothing).collect()
