"""Fill-in-the-middle transformation of documents, and its exact reversal.

A document is cut at two of its line ends into prefix, middle and suffix, which are
written in another order behind their marks. The pieces of a document go through one
exchange, keyed by document and place in the output; tasks then stream them in that
order, so neither an output nor a text is ever whole in memory. Every text that has no
mark of its own can be restored from output and form alone: the output's parts are
numbered by their place in the text and sorted again inside the partition they are in.

Null and empty texts, and those that hold a mark, stay as they are (form ``plain``). A
null id draws like an empty one. Repeated rows are documents of their own, an empty
table gives no rows, other columns are ignored. Rows of a partition must come in the
same order if a task runs again, as rows of files do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import Block, blocks, bounded_batches

PLAIN = "plain"
#: Parts in the order of the text.
PARTS = ("prefix", "middle", "suffix")
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
#: Parts in the order of the output.
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
#: Bytes of a piece: whole lines, unless one is longer.
PIECE = 64 << 10
#: Bytes of pieces that leave a task together.
_BATCH = 1 << 20
#: Places of a part's pieces in a text; the parts are that far apart.
_PART = 1 << 40


def _draw(seed: int, name: str) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    return [int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12)]


def _characters(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


class _Plan:
    """Where a text is cut, and the form of its output."""

    def __init__(self, data: np.ndarray, name: str, rate: int, spm: int, seed: int):
        self.data = data
        ends = np.flatnonzero(data == 0x0A) + 1
        self.ends = ends if not len(data) or data[-1] == 0x0A else np.append(ends, len(data))
        self.n = len(self.ends)
        text = data.tobytes()
        one, two, three, four = _draw(seed, name)
        if not text or any(mark in text for mark in MARKS.values()) or three % 100 >= rate:
            self.form, self.prefix_chars, self.middle_chars = PLAIN, None, None
            self.parts = [(b"", 0, len(text))]
            return
        cuts = sorted((one % (self.n + 1), two % (self.n + 1)))
        a, b = (int(self.ends[k - 1]) if k else 0 for k in cuts)
        self.form = "spm" if four % 100 < spm else "psm"
        self.prefix_chars, self.middle_chars = _characters(data[:a]), _characters(data[a:b])
        span = {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(text))}
        self.parts = [(MARKS[part], *span[part]) for part in FORMS[self.form]]

    def pieces(self) -> Iterator[bytes]:
        """The output in pieces of whole lines."""
        for mark, at, end in self.parts:
            first = True
            while first or at < end:
                to = min(end, at + PIECE)
                if to < end:
                    k = int(np.searchsorted(self.ends, to, "right"))
                    to = int(self.ends[k - 1]) if k and self.ends[k - 1] > at else to
                yield (mark if first else b"") + self.data[at:to].tobytes()
                at, first = to, False


class _Out:
    """Rows on their way out of a task, some at a time."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size >= _BATCH:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield self.batch()


def _ddl(id_type: str) -> str:
    """``key`` and ``position`` order the pieces; the rest of a document's columns are in one piece of it."""
    return f"key long, position long, id {id_type}, n long, form string, prefix_chars long, middle_chars long, data binary"


def _kind(df: DataFrame) -> str:
    return df.schema["id"].dataType.simpleString()


def _arrow(batch: pa.RecordBatch, *more: pa.Field) -> pa.Schema:
    """Schema of pieces, with the id as it comes from Spark."""
    return pa.schema([("key", pa.int64()), ("position", pa.int64()), ("id", batch.schema.field("id").type), ("n", pa.int64()),
                      ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("data", pa.binary()), *more])


def transform(documents: DataFrame, rate: int = 100, spm: int = 50, seed: int = 7, id_column: str = "doc_id",
              text_column: str = "text") -> DataFrame:
    """Outputs of all documents as pieces ``(key, position, id, n, form, prefix_chars,
    middle_chars, data)``, those of a document together and in order.

    ``rate`` percent of the documents are transformed, ``spm`` percent of those with the
    suffix first. The columns of the document are set in its first piece.
    """
    bounded_batches(documents.sparkSession)
    source = documents.select(F.col(id_column).alias("id"), F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("name"),
                              F.col(text_column).cast("string").alias("text"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, out = TaskContext.get().partitionId() << 40, None
        for batch in batches:
            out = out or _Out(_arrow(batch))
            ids, names = batch.column("id").to_pylist(), batch.column("name").to_pylist()
            for block in blocks(batch.column("text")):
                for row, (a, b) in enumerate(zip(block.offsets[:-1], block.offsets[1:]), block.first):
                    plan = _Plan(block.data[a:b], names[row], rate, spm, seed)
                    own = (ids[row], plan.n, plan.form, plan.prefix_chars, plan.middle_chars)
                    for position, data in enumerate(plan.pieces()):
                        yield from out.add((key, position, *(own if not position else [None] * 5), data), len(data))
                    key += 1
        if out:
            yield from out.rest()

    return _in_order(source.mapInArrow(emit, _ddl(_kind(source))).repartition("key"))


def _in_order(pieces: DataFrame) -> DataFrame:
    return pieces.sortWithinPartitions("key", "position")


def _streamed(pieces: DataFrame, begin: Callable, ddl: str, *more: pa.Field) -> DataFrame:
    """For each document, in pieces that stand in order: ``begin(own)`` gives a function of
    one piece's data (None behind the last), which gives the rows to emit."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last, step = None, None, None
        for batch in batches:
            out = out or _Out(_arrow(batch, *more))
            columns = [batch.column(c).to_pylist() for c in ("key", "id", "n", "form", "prefix_chars", "middle_chars", "data")]
            for key, *own, data in zip(*columns):
                if key != last:
                    for row in step(None) if step else ():
                        yield from out.add(row, len(row[7] or b""))
                    last, step = key, begin((key, *own))
                for row in step(data):
                    yield from out.add(row, len(row[7] or b""))
        if out:
            for row in step(None):
                yield from out.add(row, len(row[7] or b""))
            yield from out.rest()

    return pieces.mapInArrow(stream, ddl)


class _Apart:
    """Takes an output apart while its bytes come by. A mark may lie across pieces."""

    def __init__(self, form: str):
        self.parts = list(FORMS.get(form, ()))
        self.part = None if self.parts else PARTS[0]
        self.held = b""

    def feed(self, data: bytes | None) -> Iterator[tuple[str, bytes]]:
        left = self.held + (data or b"")
        while self.parts and (at := left.find(MARKS[self.parts[0]])) >= 0:
            if self.part is None and at:
                raise ValueError("an output does not begin with its mark")
            yield self.part, left[:at]
            left, self.part = left[at + len(MARKS[self.parts[0]]):], self.parts.pop(0)
        if data is None and self.parts:
            raise ValueError("an output lacks a mark")
        keep = 2 if self.parts else 0  # the begin of a mark at most
        self.held = left[max(0, len(left) - keep):] if keep else b""
        yield self.part, left[:len(left) - len(self.held)]


def restore(pieces: DataFrame) -> DataFrame:
    """The texts, in pieces in order again, from outputs in pieces: only their data and form
    are used. ``output_sha256`` in a document's first piece is the digest of its output."""

    def begin(own: tuple) -> Callable:
        key, _, _, form, *_ = own
        apart, digest, place = _Apart(form), hashlib.sha256(), dict.fromkeys(PARTS, 0)

        def step(data: bytes | None) -> Iterator[tuple]:
            digest.update(data or b"")
            for part, cut in apart.feed(data):
                if cut:
                    yield (key, PARTS.index(part) * _PART + place[part], *[None] * 5, cut, None)
                    place[part] += 1
            if data is None:
                yield (key, -1, *own[1:], b"", digest.hexdigest())

        return step

    return _in_order(_streamed(pieces, begin, _ddl(_kind(pieces)) + ", output_sha256 string", pa.field("output_sha256", pa.string())))


def texts(pieces: DataFrame) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, text)``: the pieces of each document,
    of outputs or of restored texts, as one string. A task holds one document at a time."""

    def begin(own: tuple) -> Callable:
        held = []

        def step(data: bytes | None) -> Iterator[tuple]:
            if data is None:
                yield (own[0], 0, *own[1:], b"".join(held))
            else:
                held.append(data)

        return step

    whole = _streamed(pieces.select(*_columns(pieces)), begin, _ddl(_kind(pieces)))
    return whole.select("id", "n", "form", "prefix_chars", "middle_chars", F.col("data").cast("string").alias("text"))


def _columns(pieces: DataFrame) -> list[str]:
    return [c for c in pieces.columns if c != "output_sha256"]


def digests(documents: DataFrame, **options) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)`` of each
    document: transformed, taken apart, sorted and put together again."""
    pieces = restore(transform(documents, **options))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, text, last, done, schema = None, None, None, [], None

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

        for rows in batches:
            schema = schema or pa.schema([rows.schema.field(c) for c in names[:-1]] + [pa.field(names[-1], pa.string())])
            keys, data = rows.column("key").to_pylist(), rows.column("data")
            columns = [rows.column(c) for c in names[:-1]]
            for k, key in enumerate(keys):
                if key != last:
                    if own:
                        done.append((*own, text.hexdigest()))
                    last, own, text = key, tuple(c[k].as_py() for c in columns), hashlib.sha256()
                text.update(data[k].as_buffer())
            if len(done) >= 4096:
                yield batch()
                done.clear()
        if own:
            done.append((*own, text.hexdigest()))
            yield batch()

    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    return pieces.mapInArrow(
        digest, f"id {_kind(pieces)}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
