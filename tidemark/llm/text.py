"""Vectorised words of Arrow string columns, for code that runs inside Spark tasks.

Both word classes in use split at single bytes of UTF-8, so a column's buffer is
cut without decoding. Words get 64-bit hashes: equal words have equal hashes, and
different ones differ but for a chance of 2^-64.
"""

from __future__ import annotations

import ctypes
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import SparkSession

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(int(_BASE), -1, 2**64))
#: Bytes of text that are worked on together; bounds the memory of a step, which takes some fifty times as much.
SPAN = 1 << 18
#: Bytes of a batch of rows on its way to Python; Spark's default is sixteen times that.
BATCH = 4 << 20
#: Longer words are hashed one by one: sums of powers modulo 2^64 are weak there.
LONG_WORD = 256

_LOWER = np.arange(256)
_LOWER[65:91] += 32
_CODES = np.random.default_rng(20240115).integers(0, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_FOLDED_CODES = _CODES[_LOWER]
LOWER = _LOWER.astype(np.uint8)


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.ones(256, bool)
    for first, last in ranges:
        table[first:last + 1] = False
    return table


#: Letters, digits and everything beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
ALPHANUMERIC = _class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: Everything but ASCII white space: [^\x20\x09-\x0D]+.
NON_SPACE = _class((0x20, 0x20), (0x09, 0x0D))

_powers = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SPAN)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Block:
    """Consecutive rows of a string column as bytes; a null is an empty text."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> str:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes().decode()

    def words(self, word_class: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, end and row of each word."""
        inside = word_class[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < len(inside))]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(self.offsets, starts, "right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray, limit: int | None = None, fold: bool = True) -> np.ndarray:
        """Hash of each word, with A-Z lower-cased if ``fold``; with a limit, of its first bytes, at most so many."""
        codes = _FOLDED_CODES if fold else _CODES
        out = np.empty(len(starts), U64)
        stops = ends if limit is None else np.minimum(ends, starts + limit)
        k = 0
        while k < len(starts):
            to = max(k + 1, int(np.searchsorted(ends, starts[k] + SPAN)))
            at = starts[k]
            end = stops[k] if to == k + 1 else ends[to - 1]
            if to == k + 1 and end - at > LONG_WORD:
                k = to
                continue
            power, inverse = _power_tables(int(end - at))
            total = np.zeros(len(power) + 1, U64)
            np.cumsum(codes[self.data[at:end]] * power, out=total[1:])
            s, e = starts[k:to] - at, stops[k:to] - at
            out[k:to] = mix((total[e] - total[s]) * inverse[s])
            k = to
        for k in np.flatnonzero(stops - starts > LONG_WORD):
            word = self.data[starts[k]:stops[k]]
            out[k] = xxhash.xxh3_64_intdigest((LOWER[word] if fold else word).tobytes())
        return out


def bounded_batches(spark: SparkSession) -> None:
    """Let the session send rows to Python in smaller batches: a worker and its executor
    hold several copies of one, and texts are long. A smaller setting is left alone."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    digits = spark.conf.get(name).rstrip("b")
    if not digits.isdigit() or int(digits) > BATCH:
        spark.conf.set(name, f"{BATCH}b")


#: Seconds between two times that a worker gives memory back.
_PAUSE = 1.0
_given_back = 0.0


def give_back() -> None:
    """Return freed memory to the system. Spark keeps workers between stages, and what
    they hold on to is taken from their executor."""
    global _given_back
    if time.monotonic() - _given_back < _PAUSE:
        return
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)
    _given_back = time.monotonic()


def blocks(column: pa.Array | pa.ChunkedArray, size: int = SPAN) -> Iterator[Block]:
    """Blocks of about ``size`` bytes; a longer text is a block of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield Block(row, data[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row])
        row = to
    give_back()


def grams(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of n consecutive words of a row at each place, and the index of its first word."""
    if len(words) < n:
        return np.empty(0, U64), np.empty(0, np.int64)
    last = len(words) - n + 1
    value = np.full(last, U64(n))
    for k in range(n):
        value = value * _BASE + words[k:last + k]
    whole = np.flatnonzero(rows[:last] == rows[n - 1:])
    return mix(value[whole]), whole


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    if not len(starts):
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)
