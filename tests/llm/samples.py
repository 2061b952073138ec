"""Small tables with the rows that break things, and plain Python to hold results against."""

import random
import re

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size string, score string, row string, key string"


def words(rng, n, letters="abcdefghij"):
    return [" ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(1)) for _ in range(n)]


def documents(spark, seed=1):
    """Copies, near copies, ties, nulls, blanks, a long text, repeated rows, and clashing names."""
    rng = random.Random(seed)
    base = words(rng, 60)
    texts = [" ".join(base), " ".join(base), " ".join(base[:59] + ["other"]), " ".join(base[:58] + ["x", "y"]), " ".join(base[5:]), None, "", " \n\t ",
             "one two", "one  TWO", "one two three", "Über die Straße gehen wir", "12 34 %% !!", " x  y  z\n\n w", "password = 'hunter22'"]
    texts += [" ".join(words(rng, rng.randint(3, 80))) for _ in range(25)]
    texts += [" ".join(words(rng, 20_000)), "a " * 3_000]
    for k in range(12):
        copy = list(base)
        copy[rng.randrange(60)] = f"w{k}"
        texts.append(" ".join(copy))
    rows = [(k, t, [None, "en", "de"][k % 3], [None, "a", "b", "B"][k % 4], k, "clash", "clash", "clash", "clash", "clash") for k, t in enumerate(texts)]
    rows += [rows[0], rows[20], (20, "another text of the same id entirely", "en", "a", 1, None, None, None, None, None), (None, "no id here at all", "en", "b", 1, "", "", "", "", "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


@pytest.fixture(scope="session")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return empty(spark)


def shares(sizes, weights=(1, 2, 3), repeats=3):
    """Words that sources give, in their order: by weight, at most ``repeats`` times their size."""
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    out, rest, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while rest:
        total = sum(weight[k] for k in rest)
        full = [k for k in rest if left * weight[k] / total > repeats * sizes[k]]
        for k in full or rest:
            out[k] = float(repeats * sizes[k]) if full else left * weight[k] / total
        if not full:
            break
        left -= sum(out[k] for k in full)
        rest -= set(full)
    return out
