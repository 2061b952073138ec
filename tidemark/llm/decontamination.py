"""Benchmark decontamination by winnowing.

A text's fingerprint is the smallest hash of k words in each window of ``words``
words. A window that occurs in a benchmark item and in a document has the same
fingerprint in both, so no shared span of a window or more is missed. Fingerprints
of documents are joined with those of the items, and what agrees is extended: the
windows around it are compared in full, and their words are hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.folders import written
from tidemark.llm.text import ALPHANUMERIC, U64, Block, blocks, bounded_batches, grams, ranges

#: Words of consecutive k-grams; a window of W words has W - K + 1 of them.
K = 6
#: Bytes of benchmark text in one index. A larger benchmark is cut into several, each
#: of which is sent to the executors and compared with all documents.
INDEX_BYTES = 32 << 20


def _fingerprints(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest k-gram hash of each window of ``size`` words, and the window's first word."""
    k = min(K, size)
    if len(words) < size:
        return np.empty(0, U64), np.empty(0, np.int64)
    value = np.zeros(len(words) - k + 1, U64)
    found, at = grams(words, rows, k)
    value[at] = found
    windows = np.flatnonzero(rows[:len(words) - size + 1] == rows[size - 1:])
    least = value[windows]
    for step in range(1, size - k + 1):
        least = np.minimum(least, value[windows + step])
    return least, windows


@dataclass
class _Windows:
    """Windows of one length: fingerprints, and the items of each window's hash."""

    prints: np.ndarray
    hashes: np.ndarray
    ends: np.ndarray
    items: np.ndarray


@dataclass
class Index:
    """The windows of benchmark items, by their number of words."""

    names: list
    by_size: dict[int, _Windows] = field(default_factory=dict)


def build_index(items: pa.Table, window: int) -> Index:
    """Index of a table ``(item, text)``."""
    index = Index(items.column("item").to_pylist())
    parts: dict[int, list] = {}
    for block in blocks(items.column("text")):
        starts, ends, rows = block.words(ALPHANUMERIC)
        words = block.hashes(starts, ends)
        number = np.bincount(rows, minlength=len(block))
        for size in np.unique(np.minimum(number[number > 0], window)):
            mine = np.flatnonzero(number[rows] >= window if size == window else number[rows] == size)
            least, at = _fingerprints(words[mine], rows[mine], int(size))
            whole, first = grams(words[mine], rows[mine], int(size))
            parts.setdefault(int(size), []).append((least, whole, rows[mine][first] + block.first))
    for size, found in parts.items():
        least, whole, owner = (np.concatenate(x) for x in zip(*found))
        pairs = np.unique(np.stack([whole, owner.astype(U64)], 1), axis=0)
        hashes, first = np.unique(pairs[:, 0], return_index=True)
        index.by_size[size] = _Windows(np.unique(least), hashes, np.append(first, len(pairs)), pairs[:, 1].astype(np.int64))
    return index


def _found(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value, or -1."""
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return np.where(sorted_values[at] == values, at, -1)


def _compare(block: Block, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of words of each row; row, first word and end of each hit span; row and item of each item found."""
    starts, ends, rows = block.words(ALPHANUMERIC)
    words = block.hashes(starts, ends)
    number = np.bincount(rows, minlength=len(block))
    change = np.zeros(len(words) + 1, np.int64)
    pairs = [np.empty((0, 2), np.int64)]
    for size, known in index.by_size.items():
        least, at = _fingerprints(words, rows, size)
        if not len(least):
            continue
        # neighbouring windows mostly have the same fingerprint
        run = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        hit = np.repeat(_found(known.prints, least[run]) >= 0, np.diff(np.append(run, len(least))))
        at = at[hit]
        if not len(at):
            continue
        picked = words[(at[:, None] + np.arange(size)).ravel()]
        whole, _ = grams(picked, np.repeat(np.arange(len(at)), size), size)
        place = _found(known.hashes, whole)
        at, place = at[place >= 0], place[place >= 0]
        np.add.at(change, at, 1)
        np.add.at(change, at + size, -1)
        once = np.unique(np.stack([rows[at], place], 1), axis=0)
        lengths = known.ends[once[:, 1] + 1] - known.ends[once[:, 1]]
        pairs.append(np.stack([np.repeat(once[:, 0], lengths), known.items[ranges(known.ends[once[:, 1]], lengths)]], 1))
    covered = np.cumsum(change[:-1]) > 0
    if len(words):
        begins = np.append(True, rows[1:] != rows[:-1])
        first = np.flatnonzero(covered & (begins | np.append(True, ~covered[:-1])))
        last = np.flatnonzero(covered & np.append(begins[1:] | ~covered[1:], True))
    else:
        first = last = np.empty(0, np.int64)
    begin = np.cumsum(number) - number
    pairs = np.unique(np.concatenate(pairs), axis=0)
    return number, rows[first], first - begin[rows[first]], last + 1 - begin[rows[first]], pairs


_EMPTY_SPANS, _EMPTY_ITEMS = "array<struct<first:long,after:long>>", "array<string>"


def _scan(source: DataFrame, index: Index) -> DataFrame:
    """The documents' columns without the text, and ``(n_words, spans, items)`` against one index."""
    kept = [c for c in source.columns if c != "text"]
    sent = source.sparkSession.sparkContext.broadcast(index)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = pa.array(known.names, pa.string())
        for batch in batches:
            for block in blocks(batch.column("text")):
                number, owner, first, end, pairs = _compare(block, known)
                ends = lambda rows: pa.array(np.append(0, np.cumsum(np.bincount(rows, minlength=len(block)))), pa.int32())
                spans = pa.StructArray.from_arrays([pa.array(first), pa.array(end)], ["first", "after"])
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in kept], pa.array(number.astype(np.int64)), pa.ListArray.from_arrays(ends(owner), spans),
                    pa.ListArray.from_arrays(ends(pairs[:, 0]), names.take(pa.array(pairs[:, 1]))),
                ], [*kept, "n_words", "spans", "items"])

    schema = source.select(*kept).schema.add("n_words", "long")
    for name, kind in (("spans", _EMPTY_SPANS), ("items", _EMPTY_ITEMS)):
        schema = schema.add(name, source.sparkSession.range(0).select(F.lit(None).cast(kind)).schema[0].dataType)
    return source.mapInArrow(read, schema)


def _united(spans: Column) -> Column:
    """Spans from several indexes as spans that don't overlap."""
    empty = F.array().cast(_EMPTY_SPANS)

    def add(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        return F.when(last.isNull() | (last["after"] < span["first"]), F.concat(done, F.array(span))).otherwise(F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["first"].alias("first"), F.greatest(last["after"], span["after"]).alias("after")))))

    return F.aggregate(F.array_sort(spans), empty, add)


def contamination(documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text_column: str = "text", window: int = 10,
                  index_bytes: int = INDEX_BYTES, carry: bool = False) -> DataFrame:
    """``(id, n_words, n_hit, spans, items)`` of each document; with ``carry``, also all its columns as ``row``.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A
    word is hit if it is in an occurrence of ``window`` consecutive words of an item;
    an item of fewer words is one window. ``spans`` are hit words by their numbers
    (``after`` is the first one behind), ``items`` the distinct ids of items with a
    window in the document, as strings in order. Null and empty texts have no words.
    An item with a null id hits words but is not listed; items of one id are one.
    Repeated documents get a row each, an empty benchmark hits nothing.

    The benchmark is sent to the executors in indexes of ``index_bytes`` of text, as many
    as it needs; documents are not shuffled unless there are several. Words and windows
    are compared by hashes: a false hit needs two independent collisions of 64 bits.
    """
    bounded_batches(documents.sparkSession)
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(item_text_column).cast("string").alias("text"))
    items = items.where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(size // index_bytes) + 1
    text = F.col(text_column).cast("string")
    source = documents.select(F.col(id_column).alias("id"), text.alias("text"), *([F.struct("*").alias("row")] if carry else []))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    indexes = (build_index(items.where(part == k).toArrow(), window) for k in range(parts))
    found = _scan(source, next(indexes)) if parts == 1 else _scan_parts(source, indexes)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])
    listed = F.array_sort(F.array_distinct(F.filter("items", lambda x: x.isNotNull())))
    return found.withColumns({"n_hit": hit, "items": listed}).select("id", "n_words", "n_hit", "spans", "items", *(["row"] if carry else []))


def _scan_parts(source: DataFrame, indexes: Iterator[Index]) -> DataFrame:
    """Results of several indexes united. Rows of one id and text have one result, so these two name a row."""
    marked = source.withColumn("mark", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    hits, base = None, None
    for index in indexes:
        found = _scan(marked if base is None else marked.select("id", "text", "mark"), index)
        if base is None:
            base = found = written(found, "scan")
        found = found.where("size(spans) > 0").select("id", "mark", "spans", "items")
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.groupBy(F.col("id").alias("i"), F.col("mark").alias("m")).agg(
        F.collect_set("spans").alias("s"), F.collect_set("items").alias("t")).select(
        "i", "m", _united(F.flatten("s")).alias("s"), F.flatten("t").alias("t"))
    return base.drop("spans", "items").join(hits, F.col("id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")), "left").withColumns({
        "spans": F.coalesce("s", F.array().cast(_EMPTY_SPANS)), "items": F.coalesce("t", F.array().cast(_EMPTY_ITEMS))})
