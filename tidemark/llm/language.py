"""Language identification: sparse multinomial logistic regression on character n-grams.

Weights are term frequency (as a share of a text's n-grams) times inverse document
frequency, n-grams are hashed to a fixed number of places. The regression is trained
with the follow-the-regularised-leader rule and elastic-net penalties on a bounded
sample of labelled rows; a temperature fitted on a part of them that it has not seen
calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.text import Block, blocks, bounded_batches

#: Labelled rows that the classifier is fitted on: those with the smallest hashes of their ids.
FIT_ROWS = 4_000
PLACES = 1 << 16
LENGTHS = (1, 2, 3)
UNKNOWN = "und"
_FACTORS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))
#: Feature values are shares; this brings them to the size of ones.
_SCALE = 20.0

_lower = [chr(c).lower() for c in range(1 << 16)]
_FOLD = np.array([ord(x) if len(x) == 1 else c for c, x in enumerate(_lower)], np.uint32)
_LETTER = np.array([chr(c).isalpha() for c in range(1 << 16)])


def _letters(codes: np.ndarray) -> np.ndarray:
    far = codes >= 1 << 16
    if not far.any():
        return _LETTER[codes]
    known = np.unique(codes[far])
    alpha = np.array([chr(c).isalpha() for c in known])
    out = np.empty(len(codes), bool)
    out[~far] = _LETTER[codes[~far]]
    out[far] = alpha[np.searchsorted(known, codes[far])]
    return out


def ngram_places(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hashed place of each n-gram, one length after the other. Case is folded
    and what is not a letter counts as a space; n-grams of spaces alone are left out."""
    codes = np.frombuffer(block.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    counts = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
    rows = np.repeat(np.arange(len(block), dtype=np.int32), np.diff(counts[block.offsets]))
    letter = _letters(codes)
    near = codes < 1 << 16
    folded = np.where(letter, np.where(near, _FOLD[np.where(near, codes, 0)], codes), np.uint32(32))
    for n in LENGTHS:
        last = len(folded) - n + 1
        if last <= 0:
            continue
        value, some, same = np.full(last, n, np.uint32), np.zeros(last, bool), rows[:last] == rows[n - 1:]
        for k in range(n):
            value = (value ^ folded[k:last + k]) * _FACTORS[k]
            some |= letter[k:last + k]
        some &= same
        value = value[some]
        yield rows[:last][some], ((value ^ (value >> np.uint32(15))) * _FACTORS[0]) >> np.uint32(16)


@dataclass
class Classifier:
    """Weights of each place and language, with the inverse document frequencies in them."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Logits of each row, and whether it has a letter."""
        total = np.zeros((len(block), len(self.languages)))
        number = np.zeros(len(block))
        for rows, places in ngram_places(block):
            if len(rows):
                first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
                total[rows[first]] += np.add.reduceat(self.weights[places], first, axis=0, dtype=np.float64)
                number += np.bincount(rows, minlength=len(block))
        return total * (_SCALE / np.maximum(number, 1))[:, None] + self.bias, number > 0


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str], epochs: int = 4, rate: float = 0.5,
          l1: float = 0.002, l2: float = 0.01, batch: int = 32) -> Classifier:
    """Fit the classifier on ``(places, shares)`` of texts and their languages' numbers."""
    order = np.random.default_rng(7).permutation(len(texts))
    cut = max(1, len(order) - len(order) // 5)
    fitted, held = order[:cut], order[cut:]
    found = np.zeros(PLACES)
    for k in fitted:
        found[texts[k][0]] += 1
    idf = np.log((1 + len(fitted)) / (1 + found)) + 1
    kinds = len(languages)
    z, square = np.zeros((PLACES + 1, kinds)), np.zeros((PLACES + 1, kinds))

    def weights(at: np.ndarray) -> np.ndarray:
        lasso = np.where(at == PLACES, 0.0, l1)[:, None]
        w = -(z[at] - np.sign(z[at]) * lasso) / ((1 + np.sqrt(square[at])) / rate + l2)
        return np.where(np.abs(z[at]) <= lasso, 0.0, w)

    for _ in range(epochs):
        for start in range(0, len(fitted), batch):
            mine = fitted[start:start + batch]
            at, inverse = np.unique(np.concatenate([np.append(texts[k][0].astype(np.int64), PLACES) for k in mine]), return_inverse=True)
            x = np.concatenate([np.append(texts[k][1] * idf[texts[k][0]] * _SCALE, 1.0) for k in mine])
            ends = np.cumsum([len(texts[k][0]) + 1 for k in mine])
            starts = np.append(0, ends[:-1])
            w = weights(at)
            error = _softmax(np.add.reduceat(x[:, None] * w[inverse], starts, axis=0))
            error[np.arange(len(mine)), labels[mine]] -= 1
            step = x[:, None] * np.repeat(error, np.diff(np.append(starts, len(x))), axis=0) / len(mine) ** 0.5
            gradient = np.zeros_like(w)
            np.add.at(gradient, inverse, step)
            more = square[at] + gradient**2
            z[at] += gradient - (np.sqrt(more) - np.sqrt(square[at])) / rate * w
            square[at] = more
    final = weights(np.arange(PLACES + 1))
    model = Classifier(languages, (final[:-1] * idf[:, None]).astype(np.float32), final[-1], 1.0)
    if len(held):
        logits = np.stack([(texts[k][1][:, None] * model.weights[texts[k][0]]).sum(axis=0) * _SCALE + model.bias for k in held])
        tried = np.geomspace(0.1, 10, 61)
        # ties between temperatures go to the one that changes least
        loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(held)), labels[held]], 1e-12)).mean() + 1e-6 * abs(np.log(t)) for t in tried]
        model.temperature = float(tried[int(np.argmin(loss))])
    return model


def fit(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang",
        rows: int = FIT_ROWS) -> Classifier:
    """Fit on up to ``rows`` labelled documents. Rows without a text, label or letter teach nothing."""
    bounded_batches(documents.sparkSession)
    labelled = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"),
                                F.col(label_column).cast("string").alias("label")).where("text is not null and label is not null")
    chosen = labelled.select("id", F.xxhash64("id").alias("h")).distinct().orderBy("h", "id").limit(rows).select(F.col("id").alias("chosen"))
    sample = labelled.join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("chosen"))).select("id", "text", "label")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                found = [np.concatenate(x) for x in zip(*ngram_places(block))] or [np.empty(0, np.int64)] * 2
                both, counts = np.unique(found[0].astype(np.int64) * PLACES + found[1], return_counts=True)
                row = both // PLACES
                ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(block))))
                shares = counts / np.maximum(np.bincount(row, counts, minlength=len(block)), 1)[row]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.first, len(block)), batch.column(2).slice(block.first, len(block)),
                    pa.array([(both[a:b] % PLACES).astype(np.uint16).tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                    pa.array([shares[a:b].astype(np.float32).tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                ], ["id", "label", "places", "shares"])

    kind = sample.schema["id"].dataType.simpleString()
    table = sample.mapInArrow(read, f"id {kind}, label string, places binary, shares binary")
    # An id may stand for many rows: the bound holds for them too.
    table = table.where("length(places) > 0").orderBy(F.xxhash64("id"), F.xxhash64("label", "shares")).limit(rows).toArrow()
    labels = table.column("label").to_pylist()
    languages = sorted(set(labels))
    texts = [(np.frombuffer(a, np.uint16), np.frombuffer(b, np.float32))
             for a, b in zip(table.column("places").to_pylist(), table.column("shares").to_pylist())]
    number = {x: k for k, x in enumerate(languages)}
    return train(texts, np.array([number[x] for x in labels], np.int64), languages)


def predict(documents: DataFrame, model: Classifier, text: Column | str = "text",
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The documents with the predicted language and its calibrated probability.

    ``und`` with score 0 stands for a null text, one without a letter, or any text if
    there was no labelled row to learn from. Other columns stay; a column of one of
    the new names is replaced.
    """
    bounded_batches(documents.sparkSession)
    source = documents.drop(*names).withColumn("__text", (F.col(text) if isinstance(text, str) else text).cast("string"))
    sent = documents.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in source.columns if c != "__text"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        languages = pa.array(known.languages + [UNKNOWN], pa.string())
        for batch in batches:
            for block in blocks(batch.column(batch.num_columns - 1)):
                if known.languages:
                    logits, some = known.logits(block)
                    chances = _softmax(logits / known.temperature)
                    best = np.where(some, chances.argmax(axis=1), len(known.languages))
                    score = np.where(some, chances.max(axis=1), 0.0)
                else:
                    best, score = np.zeros(len(block), np.int64), np.zeros(len(block))
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in range(len(kept))] + [languages.take(pa.array(best)), pa.array(score)], kept + list(names))

    schema = source.select([F.col(f"`{c}`") for c in kept]).schema
    schema = schema.add(names[0], "string").add(names[1], "double")
    return source.mapInArrow(read, schema)
