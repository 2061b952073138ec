import random
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from samples import docs, nothing, spaced, words  # noqa: F401
from tidemark.llm import components as steps, ngram_join
from tidemark.llm.components import components


def brute(rows, n=5, threshold=80):
    sets = [{tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set() for w in (spaced(t) for _, t in rows)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[find(k)].append(i)
    return sorted(((i, len(s), min((x for x in ids[find(k)] if x is not None), default=None) if s else i)
                   for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edge_rows(docs):
    assert got(ngram_join.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty(nothing):
    assert ngram_join.near_duplicates(nothing).collect() == [] and ngram_join.deduplicate(nothing).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_families_around_the_threshold(spark, seed):
    rng, rows = random.Random(seed), []
    for family in range(12):
        base = words(rng, rng.randint(5, 70), "abc")
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = words(rng, 1)[0]
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(ngram_join.near_duplicates(df)) == brute(rows)


def test_lists_left_open_by_the_stars(spark, monkeypatch):
    """Without a good centre every pair of different components is still counted."""
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "STAR_CENTRES", 1)
    rng, rows = random.Random(5), []
    base = words(rng, 60)
    for k in range(40):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(60)] = f"w{rng.randrange(6)}"
        rows.append((k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(ngram_join.near_duplicates(df)) == brute(rows)


def test_chains_grow_over_the_rounds(spark, monkeypatch):
    """Components of one round are joined by links of the next ones and of the last count."""
    monkeypatch.setattr(ngram_join, "STAR_CENTRES", 1)
    rng, rows = random.Random(7), []
    for family in range(3):
        text = words(rng, 80)
        for _ in range(15):
            text = list(text)
            text[rng.randrange(80)] = words(rng, 1)[0]
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(ngram_join.near_duplicates(df)) == brute(rows)


@pytest.fixture
def steps_written(monkeypatch):
    """Names of what the steps write, in order."""
    names = []
    for module in (steps, ngram_join):
        monkeypatch.setattr(module, "written", lambda df, name, real=module.written: names.append(name) or real(df, name))
    return names


def test_a_round_without_links_repeats_no_step(spark, steps_written):
    """Copies around one text are linked in the first round; nothing is left for the others."""
    rng = random.Random(3)
    base, rows = words(rng, 60), []
    for k in range(12):
        rows.append((k, " ".join(base[:59] + [f"end{k}"])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(ngram_join.near_duplicates(df)) == brute(rows)
    assert steps_written.count("edges") <= 4 and steps_written.count("open") == 1


def test_stars_are_written_once(spark, steps_written):
    df = spark.createDataFrame([(k, 0) for k in range(1, 9)] + [(11, 10)], "a long, b long")
    want = {(k, 0) for k in range(9)} | {(11, 10), (10, 10)}
    assert {tuple(r) for r in components(df).collect()} == want
    assert steps_written == ["edges"]


def test_many_ids_are_joined_by_a_shuffle(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    assert got(ngram_join.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_deduplicate_keeps_one_of_each_group(docs):
    kept = ngram_join.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert set(left) <= set(rows)
    assert all(i == c or not n for i, n, c in brute(left)) and len([1 for _, t in left if spaced(t)]) == len(
        {tuple(sorted(spaced(t))) for _, t in left if spaced(t)})
    reps = {c for _, n, c in brute(rows) if n}
    assert {i for i, t in left if spaced(t)} >= reps - {None}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, edges):
    df = spark.createDataFrame(edges + [(None, 1)], "a long, b long")
    root = list(range(13))
    for a, b in edges * 13:
        root[a] = root[b] = min(root[a], root[b])
    want = {(x, root[x]) for e in edges if e[0] != e[1] for x in e}
    assert {tuple(r) for r in components(df).collect()} == want
