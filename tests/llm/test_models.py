"""Classifiers: held-out accuracy on the given tables, and defined results at the edges."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from samples import docs, nothing  # noqa: F401
from conftest import SF
from tidemark.llm import language, queries, toxicity
from tidemark.llm.text import blocks

LARGER = SF.replace("0.001", "0.01")


def test_language_on_held_out_documents(spark):
    rows = queries.QUERIES["op9_language_id"](spark, LARGER).join(
        spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, docs, nothing):
    model = language.fit(docs)
    out = language.predict(docs, model, names=("size", "guess"))
    assert out.columns == [c for c in docs.columns if c != "size"] + ["size", "guess"] and out.count() == docs.count()
    und = {r.text for r in out.where(F.col("size") == "und").collect()}
    assert und == {None, "", " \n\t ", "12 34 %% !!"}
    assert language.predict(nothing, model).collect() == []
    untaught = language.fit(nothing)
    assert {(r.lang_pred, r.score) for r in language.predict(docs, untaught).collect()} == {("und", 0.0)}


def test_language_learns_nothing_from_ids_and_ignores_case():
    texts = ["Straße und Weg", "straSSE UND weg", "\U0001d4d0\U0001d4d1 x", "…"]
    block = next(blocks(pa.array(texts)))
    found = {row: set() for row in range(4)}
    for rows, places in language.ngram_places(block):
        for r, p in zip(rows, places):
            found[r].add(p)
    assert len(found[0] & found[1]) > len(found[0]) / 2 and found[2] and not found[3]


def test_temperature_and_sparsity():
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for k in range(400):
        places = np.unique(rng.integers(0, 200, 30) + 200 * (k % 2))
        texts.append((places, np.full(len(places), 1 / len(places))))
        labels.append(k % 2 if rng.random() < 0.9 else 1 - k % 2)
    model = language.train(texts, np.array(labels), ["a", "b"])
    assert (model.weights[1000:] == 0).all() and 0.1 <= model.temperature <= 10


def test_toxicity_on_held_out_documents(spark):
    large = SF.replace("0.001", "0.1")
    model = toxicity.ToxicityModel.fit(spark.read.parquet(f"{large}/documents.parquet"), spark.read.parquet(f"{large}/labels.parquet").where(~queries.held_out("doc_id", 5, 0)))
    labels = spark.read.parquet(f"{large}/labels.parquet").where(queries.held_out("doc_id", 5, 0)).where("toxic is not null")
    docs = spark.read.parquet(f"{large}/documents.parquet").join(labels.select("doc_id", "toxic"), "doc_id")
    rows = model.score(docs).join(docs.select(F.col("doc_id").alias("id"), "toxic"), "id").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    wins = (s[y == 1][:, None] > s[y == 0][None]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None]).mean()
    assert wins > 0.98 and ((s >= 0.5) == (y == 1)).mean() > 0.97
    assert s.min() >= 0 and s.max() <= 1


def test_toxicity_edges(spark, docs, nothing):
    labels = spark.createDataFrame([(k, k % 2, "x") for k in range(40)] + [(3, None, "x"), (None, 1, "x"), (5, 1, "x"), (5, 0, "x")], "doc_id long, toxic int, score string")
    model = toxicity.ToxicityModel.fit(docs, labels)
    out = model.score(docs)
    assert out.count() == docs.count() and all(0 <= r.score <= 1 for r in out.collect())
    assert model.score(nothing).collect() == []
    for none in (labels.limit(0), labels.where("toxic = 1")):
        assert {r.score for r in toxicity.ToxicityModel.fit(docs, none).score(docs).collect()} == {0.0 if none.limit(1).count() == 0 else 1.0}


@pytest.mark.parametrize("text", ["", "a", "YOU st*pid 1d10t!!", "é" * 300])
def test_features_are_finite(text):
    block = next(blocks(pa.array([text, None, text])))
    values = toxicity.features(block, toxicity.Lexicon(np.empty(0, np.uint64), np.empty(0)))
    assert values.shape == (3, len(toxicity.FEATURES)) and np.isfinite(values).all() and (values[0] == values[2]).all()
    assert text or (values == 0).all()


def plain_features(text, weights):
    """The 16 features by loops. ``weights`` of terms as text: words, and beginnings of longer ones."""
    text = text or ""
    data = text.encode()
    fold = lambda w: bytes(b + 32 if 65 <= b <= 90 else b for b in w)
    raw = [m.encode() for m in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    words = [fold(w) for w in raw]
    weight = [max([0.0, *(weights.get(t, 0.0) for t in {w, *(w[:n] for n in toxicity.PREFIXES if len(w) > n)})]) for w in words]
    person = [w.decode() in toxicity.SECOND_PERSON for w in words]
    hits = [x > 0 for x in weight]
    near = [h and any(person[max(0, k - toxicity.NEAR):k + toxicity.NEAR + 1]) for k, h in enumerate(hits)]
    alpha = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    masked = sum(chr(data[k]) in "*@$#0123456789" and alpha(data[k - 1]) and alpha(data[k + 1]) for k in range(1, len(data) - 1))
    shouted = sum(len(w) > 2 and all(65 <= b <= 90 for b in w) for w in raw)
    signs = sum(33 <= b < 48 or 58 <= b < 65 or 91 <= b < 97 or 123 <= b < 127 for b in data)
    some, letters = max(1, len(words)), max(1, sum(map(alpha, data)))
    return [100 * sum(weight) / some, 100 * sum(hits) / some, max([0, *weight]), math.log1p(sum(weight)), math.log1p(sum(hits)), 100 * sum(near) / some,
            sum(near) / max(1, sum(hits)), 100 * sum(person) / some, sum(65 <= b <= 90 for b in data) / letters, 100 * shouted / some,
            100 * data.count(33) / some, 100 * data.count(63) / some, signs / max(1, len(data)), 100 * masked / some, math.log1p(len(words)),
            sum(map(len, words)) / some]


def test_features_against_loops(docs):
    texts = [r.text for r in docs.collect()] + ["YOU are an id1ot, st*pid!! WHY?? your f@ce 4u", "Vous êtes ÉCŒURANT #1 !", "du du du toxic words here toxicwords", "a1b2c3 x*y", "?" * 50]
    weights = {b"toxic": 1.5, b"id": 2.0, b"f": 0.25, b"w1": 0.5, "êtes".encode(): 3.0, b"your": 0.125, b"abcde": 4.0}
    block = next(blocks(pa.array(list(weights), pa.binary()).cast(pa.string())))
    hashes = block.hashes(block.offsets[:-1], block.offsets[1:])
    order = np.argsort(hashes)
    lexicon = toxicity.Lexicon(hashes[order], np.array(list(weights.values()))[order])
    for part in blocks(pa.array(texts, pa.string())):
        got = toxicity.features(part, lexicon)
        for row, text in zip(got, texts[part.first:part.first + len(part)]):
            np.testing.assert_allclose(row, plain_features(text, weights), rtol=1e-9, atol=1e-12)


def plain_logits(text, model):
    """Sums over n-grams one by one: letters lower-cased, all else a space."""
    text = "".join(chr(language._FOLD[ord(c)]) if ord(c) < 1 << 16 and c.isalpha() else c if c.isalpha() else " " for c in text or "")
    codes, total, number = [ord(c) for c in text], np.zeros(len(model.languages)), 0
    for n in language.LENGTHS:
        for k in range(len(codes) - n + 1):
            gram = codes[k:k + n]
            if any(chr(c).isalpha() for c in gram):
                value = n
                for c, factor in zip(gram, (2654435761, 2246822519, 3266489917)):
                    value = (value ^ c) * factor % 2**32
                place = (value ^ (value >> 15)) * 2654435761 % 2**32 >> 16
                total += model.weights[place]
                number += 1
    return total * 20.0 / max(number, 1) + model.bias, number > 0


def test_logits_against_loops(docs):
    model = language.fit(docs)
    texts = [r.text for r in docs.where("length(text) < 2000").collect()] + [None, "İstanbul ǅ ﬁ \U0001d4d0 ß", "x", "…"]
    for part in blocks(pa.array(texts, pa.string())):
        logits, some = model.logits(part)
        for row, has, text in zip(logits, some, texts[part.first:part.first + len(part)]):
            want, letters = plain_logits(text, model)
            assert has == letters
            np.testing.assert_allclose(row, want, rtol=1e-5, atol=1e-5)


def test_labels_of_held_out_rows_teach_nothing(spark):
    """With these labels changed every result is the same."""
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    aside = queries.held_out("doc_id", 4, 2)
    other = docs.withColumn("lang", F.when(aside, F.reverse("lang")).otherwise(F.col("lang"))).withColumn("source", F.lit("x"))
    found = [{r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, language.fit(d.where(~aside))).select("doc_id", "lang_pred", "score").collect()} for d in (docs, other)]
    assert found[0] == found[1]
    aside = queries.held_out("doc_id", 5, 0)
    other = labels.withColumn("toxic", F.when(aside, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    found = [{r.id: r.score for r in toxicity.ToxicityModel.fit(docs, t.where(~aside)).score(docs).collect()} for t in (labels, other)]
    assert found[0] == found[1]


def test_an_id_of_very_many_rows_does_not_fill_the_sample(spark, docs):
    """A third of the table is one labelled id, once as copies and once with other texts each."""
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    for text in ("'the same you idiot'", "concat('text ', id)"):
        many = docs.select("doc_id", "text").unionByName(spark.range(600).selectExpr("7L AS doc_id", f"{text} AS text"))
        model = toxicity.ToxicityModel.fit(many, labels, rows=50)
        assert model.score(many).count() == many.count()
