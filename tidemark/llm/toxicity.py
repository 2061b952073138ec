"""Toxicity: gradient-boosted trees over a few dense features, with isotonic calibration.

The lexicon is learned: terms (words and beginnings of words, by hash) that labelled
toxic documents have more often than clean ones. Features are densities of it, its
nearness to the second person, capitals, punctuation and obfuscation. Everything is
fitted on a bounded sample of labelled rows. A row's features for the fit use a
lexicon learned from the other half of the sample, so the trees see densities as
they are in documents that the lexicon doesn't know.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.folders import written
from tidemark.llm.text import ALPHANUMERIC, U64, Block, blocks, bounded_batches

#: Labelled rows that everything is fitted on: those with the smallest hashes of their ids.
FIT_ROWS = 12_000
#: Terms of toxic rows that are counted in clean ones, and terms of a lexicon.
CANDIDATES, TERMS = 50_000, 4_000
#: Bytes of a word's beginnings that are terms, beside the whole word.
PREFIXES = (5, 6, 7)
TREES, DEPTH = 20, 3
NEAR = 5
#: Fixed list: pronouns of the second person in the languages of the corpus.
SECOND_PERSON = ("you", "your", "yours", "yourself", "youre", "u", "ur", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos",
                 "du", "dich", "dir", "dein", "deine", "ihr", "euch", "euer", "sie", "ti", "tus", "usted", "ustedes", "vosotros")

FEATURES = ("term_weight", "term_share", "heaviest", "total_weight", "hits", "near_person", "near_ratio", "person_share",
            "capitals", "shouted", "exclamations", "questions", "signs", "obfuscated", "words", "word_length")


def _pronouns() -> np.ndarray:
    block = next(blocks(pa.array(SECOND_PERSON)))
    return np.sort(block.hashes(*block.words(ALPHANUMERIC)[:2]))


_PRONOUNS = _pronouns()
_UPPER, _ALPHA = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA[65:91] = _ALPHA[97:123] = True
_ALPHA[128:] = True
_MASK = np.zeros(256, bool)
_MASK[[ord(c) for c in "*@$#0123456789"]] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:48] = _SIGN[58:65] = _SIGN[91:97] = _SIGN[123:127] = True


@dataclass
class Lexicon:
    """Hashes of terms in order, with their weights."""

    terms: np.ndarray
    weights: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, self.weights[at], 0.0)


def _terms(block: Block, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words' numbers and hashes of their terms, one kind after the other."""
    yield np.arange(len(starts)), block.hashes(starts, ends)
    for size in PREFIXES:
        longer = np.flatnonzero(ends - starts > size)
        yield longer, block.hashes(starts[longer], ends[longer], limit=size)


def features(block: Block, lexicon: Lexicon) -> np.ndarray:
    """A row of FEATURES for each text. All are 0 for an empty one."""
    n = len(block)
    starts, ends, rows = block.words(ALPHANUMERIC)
    weight = np.zeros(len(starts))
    person = np.zeros(len(starts), bool)
    for k, (at, hashes) in enumerate(_terms(block, starts, ends)):
        weight[at] = np.maximum(weight[at], lexicon.of(hashes))
        if not k and len(hashes):
            found = np.minimum(np.searchsorted(_PRONOUNS, hashes), len(_PRONOUNS) - 1)
            person = _PRONOUNS[found] == hashes
    count = lambda values, at=rows: np.bincount(at, values, minlength=n).astype(float)
    words = np.bincount(rows, minlength=n)
    begin = np.cumsum(words) - words
    hit = weight > 0
    before = np.append(0, np.cumsum(person))
    place = np.arange(len(starts))
    low, high = np.maximum(place - NEAR, begin[rows]), np.minimum(place + NEAR + 1, begin[rows] + words[rows])
    near = hit & (before[high] > before[low])
    heaviest = np.zeros(n)
    np.maximum.at(heaviest, rows, weight)
    byte = np.diff(block.offsets)
    owner = np.repeat(np.arange(n), byte)
    data = block.data
    alpha = _ALPHA[data]
    masked = np.zeros(len(data), bool)
    masked[1:-1] = _MASK[data[1:-1]] & alpha[:-2] & alpha[2:] & (owner[:-2] == owner[2:])
    upper = np.append(0, np.cumsum(_UPPER[data]))
    shouted = (upper[ends] - upper[starts] == ends - starts) & (ends - starts > 2)
    some, chars, letters = np.maximum(words, 1), np.maximum(byte, 1), np.maximum(count(alpha, owner), 1)
    hits, nears = count(hit), count(near)
    return np.stack([
        100 * count(weight) / some, 100 * hits / some, heaviest, np.log1p(count(weight)), np.log1p(hits), 100 * nears / some,
        nears / np.maximum(hits, 1), 100 * count(person) / some, count(_UPPER[data], owner) / letters, 100 * count(shouted) / some,
        100 * count(data == 33, owner) / some, 100 * count(data == 63, owner) / some, count(_SIGN[data], owner) / chars,
        100 * count(masked, owner) / some, np.log1p(words), count(ends - starts) / some], axis=1)


def _weighed(terms: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> Lexicon:
    """Terms whose odds are clearly higher in toxic rows, with the logarithm of that ratio."""
    ratio = np.log((toxic + 0.5) / (n_toxic - toxic + 0.5)) - np.log((clean + 0.5) / (n_clean - clean + 0.5))
    surety = ratio / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    good = np.flatnonzero((surety >= 3) & (toxic >= 2))
    good = good[np.lexsort((terms[good], -surety[good]))][:TERMS]
    good = good[np.argsort(terms[good])]
    return Lexicon(terms[good], ratio[good])


def _learn(sample: DataFrame) -> list[Lexicon]:
    """Lexicons from half 1, half 0 and all of the sample ``(id, text, label, half)``."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = batch.column("half").to_numpy()
            for block in blocks(batch.column("text")):
                starts, ends, rows = block.words(ALPHANUMERIC)
                found = [(rows[at], hashes) for at, hashes in _terms(block, starts, ends)]
                both = np.unique(np.stack([np.concatenate([h for _, h in found]), np.concatenate([r for r, _ in found]).astype(U64)], 1), axis=0)
                half = halves[block.first + both[:, 1].astype(np.int64)].astype(U64)
                kinds, counts = np.unique(np.stack([both[:, 0], half], 1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds[:, 0].view(np.int64)), pa.array(kinds[:, 1].astype(np.int32)), pa.array(counts.astype(np.int64))],
                    ["term", "half", "n"])

    def halves_of(table: DataFrame, label: int) -> DataFrame:
        return table.where(F.col("label") == label).mapInArrow(seen, "term long, half int, n long").groupBy("term").agg(
            *[F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0)).alias(f"n{h}") for h in (0, 1)])

    totals = {(r["label"], r["half"]): r["count"] for r in sample.groupBy("label", "half").count().collect()}
    toxic = halves_of(sample, 1).where("n0 + n1 >= 2").orderBy((F.col("n0") + F.col("n1")).desc(), "term").limit(CANDIDATES)
    toxic = written(toxic, "terms")
    clean = halves_of(sample, 0).select("term", F.col("n0").alias("c0"), F.col("n1").alias("c1"))
    counts = toxic.join(clean, "term", "left").fillna(0).toArrow()
    terms = counts.column("term").to_numpy().view(U64)
    order = np.argsort(terms)
    t, c = ([counts.column(f"{kind}{h}").to_numpy()[order].astype(float) for h in (0, 1)] for kind in ("n", "c"))
    number = lambda label, *halves: float(sum(totals.get((label, h), 0) for h in halves))
    return [_weighed(terms[order], t[1], c[1], number(1, 1), number(0, 1)), _weighed(terms[order], t[0], c[0], number(1, 0), number(0, 0)),
            _weighed(terms[order], t[0] + t[1], c[0] + c[1], number(1, 0, 1), number(0, 0, 1))]


def _featured(documents: DataFrame, lexicons: list[Lexicon], kept: list[str]) -> DataFrame:
    """``kept`` columns and FEATURES. ``half`` says which lexicon a row gets."""
    sent = documents.sparkSession.sparkContext.broadcast(lexicons)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            halves = batch.column("half").to_numpy()
            for block in blocks(batch.column("text")):
                part, half = batch.slice(block.first, len(block)), halves[block.first:block.first + len(block)]
                values = features(block, known[half[0]])
                for other in set(half.tolist()) - {half[0]}:
                    values[half == other] = features(block, known[other])[half == other]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array(values[:, k]) for k in range(len(FEATURES))], kept + list(FEATURES))

    schema = documents.select(*kept).schema
    for name in FEATURES:
        schema = schema.add(name, "double")
    return documents.select(*kept, "text", "half").mapInArrow(read, schema)


class ToxicityModel:
    """Lexicon, trees and calibration; without trees, the share of toxic labels is every score."""

    def __init__(self, lexicon: Lexicon, trees, calibration, base: float):
        self.lexicon, self.trees, self.calibration, self.base = lexicon, trees, calibration, base

    @classmethod
    def fit(cls, documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            label_column: str = "toxic", rows: int = FIT_ROWS) -> ToxicityModel:
        """Fit on up to ``rows`` labelled documents, those with the smallest hashes of their ids.
        Null labels, ids and texts teach nothing; of several labels of an id the highest counts,
        equal rows are one."""
        bounded_batches(documents.sparkSession)
        chosen = labels.select(F.col(id_column).alias("i"), F.col(label_column).cast("int").alias("label")).where("i is not null and label is not null")
        chosen = chosen.groupBy("i").agg((F.max("label") > 0).cast("int").alias("label")).orderBy(F.xxhash64("i"), "i").limit(rows)
        source = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).where("text is not null")
        # An id may stand for many rows: equal ones are one, and the bound holds for the others too.
        mark = F.xxhash64("text")
        sample = source.join(F.broadcast(chosen), F.col("id") == F.col("i")).groupBy("id", "label", mark.alias("mark")).agg(F.first("text").alias("text"))
        sample = written(sample, "labelled")
        kept = sample.select(F.col("id").alias("k"), F.col("mark").alias("m")).orderBy(F.xxhash64("k"), "k", "m").limit(rows)
        sample = sample.join(F.broadcast(kept), (F.col("id") == F.col("k")) & (F.col("mark") == F.col("m"))).drop("k", "m", "mark")
        sample = written(sample.withColumn("half", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int")), "sample")
        counts = sample.agg(F.count("*"), F.sum("label")).first()
        base = float(counts[1] or 0) / counts[0] if counts[0] else 0.0
        if not 0 < base < 1:
            return cls(Lexicon(np.empty(0, U64), np.empty(0)), None, None, base)
        lexicons = _learn(sample)
        table = written(_featured(sample, lexicons, ["id", "label"]), "features")
        table = _assembled(table).select("features", F.col("label").cast("double").alias("label"),
                                         (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(4)) == 0).alias("aside")).coalesce(4)
        known = [r[0] for r in table.where("not aside").select("label").distinct().collect()]
        if len(known) < 2:
            return cls(lexicons[2], None, None, base)
        trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=3).fit(table.where("not aside"))
        raw = trees.transform(table.where("aside")).select(F.element_at(vector_to_array("probability"), 2).alias("raw"), "label")
        calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(raw) if raw.head(1) else None
        return cls(lexicons[2], trees, calibration, base)

    def score(self, documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """``(id, score)`` of each document, a row each; a null text is an empty one.

        The score is the calibrated probability. Calibration maps many documents to one
        value, so a thousandth of the score is the trees' own probability.
        """
        bounded_batches(documents.sparkSession)
        source = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.lit(0).alias("half"))
        if self.trees is None:
            return source.select("id", F.lit(self.base).alias("score"))
        table = _assembled(_featured(source, [self.lexicon], ["id"]))
        raw = F.element_at(vector_to_array("probability"), 2)
        scored = self.trees.transform(table).select("id", raw.alias("raw"))
        if self.calibration is None:
            return scored.select("id", F.col("raw").alias("score"))
        return self.calibration.transform(scored).select(
            "id", (0.999 * F.greatest(F.least("calibrated", F.lit(1.0)), F.lit(0.0)) + 0.001 * F.col("raw")).alias("score"))


def _assembled(table: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
