import math
import random

import pytest

from tidemark.llm import vector_search


def brute(rows, queries, k):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    q8 = lambda v: [math.floor(256 * x) for x in v]
    data = [(i, q8(v)) for i, v in rows if i is not None and ok(v)]
    out = []
    for i, v in {(i, tuple(v)) for i, v in queries if i is not None and ok(v)}:
        scores = sorted((-sum(a * b for a, b in zip(q8(v), w)), j) for j, w in data if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


def frames(spark, rows):
    return spark.createDataFrame([(i, v, 1, "q") for i, v in rows], "vec_id long, embedding array<float>, cell int, q string").repartition(3)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_agrees_with_brute_force(spark, monkeypatch, spread):
    for name, value in (("PIVOT_VECTORS", 50), ("BLOCK_VECTORS", 20), ("BLOCK_QUERIES", 3), ("SAMPLE", 30), ("_CHUNK", 2), ("_STEP", 3), ("FIRST_RINGS", 1), ("MORE", 2)):
        monkeypatch.setattr(vector_search, name, value)
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    exact = lambda x: round(x * 1024) / 1024
    rows = [(k, [exact(c + rng.gauss(0, spread)) for c in rng.choice(centres)]) for k in range(300)]
    rows += [(400 + k, rows[0][1]) for k in range(60)]  # one very common vector
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (505, []), (506, [1.0, 2.0]), (None, rows[1][1]), rows[7], (600, [2.0**17] * 6)]
    queries = [r for r in rows if r[0] is not None and r[0] % 10 == 0] + [rows[7]]
    found = vector_search.top_k(frames(spark, rows), frames(spark, queries), 5)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, queries, 5)


def test_few_and_none(spark):
    rows = [(1, [1.0, 0.5]), (2, [0.5, 1.0])]
    assert sorted(tuple(r) for r in vector_search.top_k(frames(spark, rows), frames(spark, rows)).collect()) == brute(rows, rows, 5)
    none = frames(spark, rows).limit(0)
    assert vector_search.top_k(none, none).collect() == [] == vector_search.top_k(frames(spark, rows), none).collect()
    assert vector_search.top_k(frames(spark, rows[:1]), frames(spark, rows[:1])).collect() == []


def test_large_components_take_part(spark):
    rows = [(1, [1.0, 2.0]), (2, [300_000.0, 1.0]), (3, [2.0**24, -(2.0**24)]), (4, [-1.0, 0.0]), (5, [2.0**18, 1.0])]
    assert sorted(tuple(r) for r in vector_search.top_k(frames(spark, rows), frames(spark, rows[:2] + rows[3:4])).collect()) == brute(rows, rows[:2] + rows[3:4], 5)


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0]), (2, [1e30, 1.0])], [(1, [2.0**40] * 3), (2, [2.0**40] * 3)]])
def test_a_score_beyond_64_bits_is_an_error(spark, rows):
    with pytest.raises(Exception, match="does not fit 64 bits"):
        vector_search.top_k(frames(spark, rows), frames(spark, rows)).collect()


def test_scores_beyond_doubles_are_exact():
    import numpy as np

    a, b = np.array([[2**31, 3], [2**30, 1]]), np.array([[2**31 + 1, 5], [7, 2**30]])
    assert vector_search._scores(a, b, np.zeros((2, 2), bool)).tolist() == [[int(x) for x in r] for r in (a.astype(object) @ b.astype(object).T)]


def test_bounds_spare_most_of_clustered_vectors(spark, monkeypatch):
    """The share of all pairs that are compared."""
    for name, value in (("PIVOT_VECTORS", 200), ("SAMPLE", 200), ("_CHUNK", 8), ("_STEP", 16)):
        monkeypatch.setattr(vector_search, name, value)
    rng = random.Random(9)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(20)]
    unit = lambda v: [x / math.sqrt(sum(y * y for y in v)) for x in v]
    rows = [(k, [round(x * 1024) / 1024 for x in unit([c + rng.gauss(0, 0.03) for c in centres[k % 20]])]) for k in range(4000)]
    pairs = spark.sparkContext.accumulator(0)
    found = vector_search.top_k(frames(spark, rows), frames(spark, rows[::50]), compared=pairs).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, rows[::50], 5)
    assert 0 < pairs.value < 0.35 * 80 * 4000


def test_empty_vectors_only(spark):
    rows = [(1, []), (2, [])]
    assert sorted(tuple(r) for r in vector_search.top_k(frames(spark, rows), frames(spark, rows)).collect()) == brute(rows, rows, 5)
