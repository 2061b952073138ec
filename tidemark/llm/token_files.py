"""Token ids of documents in binary shards, with a minimal perfect hash index.

A token folder has two tables:

``payload``  rows of about BLOCK_IDS ids: ``shard``, ``first`` and ``before`` (ids and
             documents of the shard before the row), ``n_ids``, ``width`` (bytes of an
             id), ``ids`` (raw, little-endian), and the directory of its documents,
             ``keys`` and ``lengths``.
``index``    one row for each part of the keys: the levels and bits of a minimal perfect
             hash, and at a key's number its fingerprint, shard, row (``first``), offset and length.

Documents are in ascending order of id (null first, then by a hash of the text) over
all shards. Both are written by Spark's own writer, so any shared store will do and a
lost executor's part is written again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import perfect_hash
from tidemark.llm.chunk_encoder import encoder
from tidemark.llm.folders import written
from tidemark.llm.text import U64, blocks, bounded_batches

BLOCK_IDS = 1 << 20
#: Keys in one part of the index.
PART_KEYS = 1 << 16
#: Bytes of text that are encoded together.
_BLOCK_BYTES = 1 << 20
_TYPES = {2: np.dtype("<u2"), 4: np.dtype("<u4")}


def _kind(df: DataFrame, column: str) -> str:
    return df.select(column).schema[0].dataType.simpleString()


def write_payload(documents: DataFrame, folder: str, tokenizer: str, end_id: int, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """Encode and write all documents. A null text is an empty one; each text gets ``end_id`` at its end.
    The name of a special token in a text is that token, as in the library's plain ``encode``."""
    bounded_batches(documents.sparkSession)
    source = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shard, first, before = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        kind = _TYPES[known.width]
        held, keys, lengths, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "first": pa.array([first], pa.int64()), "before": pa.array([before], pa.int64()),
                "n_ids": pa.array([size], pa.int64()), "width": pa.array([known.width], pa.int32()), "ids": pa.array([np.concatenate(held).astype(kind).tobytes()], pa.binary()),
                "keys": pa.ListArray.from_arrays(pa.array([0, sum(map(len, keys))], pa.int32()), pa.concat_arrays(keys)),
                "lengths": pa.array([np.concatenate(lengths).astype("<i8").tobytes()], pa.binary())})

        for batch in batches:
            for block in blocks(batch.column(1), _BLOCK_BYTES):
                ids, number = known.encode_block(block)
                number = number + 1
                ends = np.cumsum(number) - 1
                out = np.full(len(ids) + len(number), end_id, np.uint32)
                inside = np.ones(len(out), bool)
                inside[ends] = False
                out[inside] = ids
                held.append(out)
                keys.append(batch.column(0).slice(block.first, len(block)))
                lengths.append(number)
                size += len(out)
                if size >= BLOCK_IDS:
                    yield flush()
                    first, before = first + size, before + sum(map(len, keys))
                    held, keys, lengths, size = [], [], [], 0
        if held:
            yield flush()

    rows = ordered.mapInArrow(
        encode, f"shard int, first long, before long, n_ids long, width int, ids binary, keys array<{_kind(source, 'id')}>, lengths binary")
    rows.write.parquet(f"{folder}/payload")
    return payload(documents.sparkSession, folder)


def payload(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/payload")


def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def directory(table: DataFrame) -> DataFrame:
    """``(id, shard, first, offset, n_tokens, place)`` of each document; first is that of its
    row of ids, place its number in the shard. The ids themselves are not read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                keys = batch.column(2)[k].values
                lengths = np.frombuffer(batch.column(3)[k].as_py(), "<i8")
                first = batch.column(1)[k].as_py()
                yield pa.RecordBatch.from_arrays([
                    keys, pa.array(np.full(len(keys), batch.column(0)[k].as_py(), np.int32)), pa.array(np.full(len(keys), first, np.int64)),
                    pa.array(first + np.cumsum(lengths) - lengths), pa.array(lengths), pa.array(batch.column(4)[k].as_py() + np.arange(len(keys)))],
                    ["id", "shard", "first", "offset", "n_tokens", "place"])

    kind = table.schema["keys"].dataType.elementType.simpleString()
    return table.select("shard", "first", "keys", "lengths", "before").mapInArrow(
        read, f"id {kind}, shard int, first long, offset long, n_tokens long, place long")


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``(shard, start, rows)``: ids and documents in the shards before. One row for each
    writing task comes to the driver."""
    ends = payload(spark, folder).groupBy("shard").agg(
        F.sum("n_ids").alias("ids"), F.sum(F.size("keys")).alias("documents")).orderBy("shard").collect()
    starts, rows = np.cumsum([0] + [r["ids"] for r in ends]), np.cumsum([0] + [r["documents"] for r in ends])
    # An Arrow table needs no Python workers: for a list Spark starts others than those of the operators, and keeps them.
    return spark.createDataFrame(pa.table({
        "shard": pa.array([r["shard"] for r in ends], pa.int32()), "start": pa.array(starts[:-1], pa.int64()), "rows": pa.array(rows[:-1], pa.int64())}))


def numbered(entries: DataFrame, starts: DataFrame) -> DataFrame:
    """Entries with ``occurrence``: how many documents of the same id come before.

    Equal ids stand together, so it is the number of documents since the first of them.
    That is found before the join, which then splits a frequent id.
    """
    placed = entries.join(starts, "shard").withColumn("place", F.col("rows") + F.col("place"))
    least = placed.groupBy(F.col("id").alias("i")).agg(F.min("place").alias("least"))
    return placed.join(least, F.col("id").eqNullSafe(F.col("i"))).select(
        "id", (F.col("place") - F.col("least")).alias("occurrence"), "shard", "first", "offset", "n_tokens")


def _keys() -> list:
    key = F.to_json(F.struct("id"))
    return [F.xxhash64(key, "occurrence").alias("one"), F.xxhash64(F.lit("2"), key, "occurrence").alias("two")]


def write_index(entries: DataFrame, folder: str) -> DataFrame:
    """Index ``(id, occurrence, shard, first, offset, n_tokens)`` entries."""
    keyed = entries.select(*_keys(), "shard", "first", "offset", "n_tokens")
    parts = max(1, -(-entries.count() // PART_KEYS))

    def build(table: pa.Table) -> pa.Table:
        one, two = (table.column(c).to_numpy().view(U64) for c in ("one", "two"))
        sizes, bits, number = perfect_hash.build(one, two)

        def at(values: np.ndarray) -> bytes:
            out = np.empty(len(values), values.dtype)
            out[number] = values
            return out.tobytes()

        return pa.table({
            "part": table.column("part").slice(0, 1), "sizes": [sizes], "bits": pa.array([bits.tobytes()], pa.binary()),
            "prints": pa.array([at(two.astype(np.uint32))], pa.binary()),
            **{c: pa.array([at(table.column(c).to_numpy())], pa.binary()) for c in ("shard", "first", "offset", "n_tokens")}})

    keyed.withColumn("part", F.pmod("one", F.lit(parts))).groupBy("part").applyInArrow(
        build, "part long, sizes array<long>, bits binary, prints binary, shard binary, first binary, offset binary, n_tokens binary"
    ).withColumn("parts", F.lit(parts)).write.parquet(f"{folder}/index")
    return index(entries.sparkSession, folder)


def locate(keys: DataFrame, table: DataFrame) -> DataFrame:
    """``(id, occurrence, shard, first, offset, n_tokens)`` of the keys that the index has. Each
    costs a hash, a bit, a rank and a fingerprint, however many keys there are."""
    first = table.select("parts").first()
    parts = first[0] if first else 1
    asked = keys.select("id", "occurrence", *_keys()).withColumn("part", F.pmod("one", F.lit(parts)))
    kind = _kind(keys, "id")

    def find(asked: pa.Table, known: pa.Table) -> pa.Table:
        out = asked.select(["id", "occurrence"])
        if not known.num_rows:
            return _empty(out)
        one, two = (asked.column(c).to_numpy().view(U64) for c in ("one", "two"))
        row = known.slice(0, 1).to_pylist()[0]
        number = perfect_hash.find(row["sizes"], np.frombuffer(row["bits"], np.uint8), one, two)
        prints = np.frombuffer(row["prints"], np.uint32)
        found = np.flatnonzero((number >= 0) & (prints[np.maximum(number, 0)] == two.astype(np.uint32)))
        out, number = out.take(pa.array(found)), number[found]
        for name, type_ in (("shard", np.int32), ("first", np.int64), ("offset", np.int64), ("n_tokens", np.int64)):
            out = out.append_column(name, pa.array(np.frombuffer(row[name], type_)[number]))
        return out

    def _empty(out: pa.Table) -> pa.Table:
        out = out.slice(0, 0)
        for name, type_ in (("shard", pa.int32()), ("first", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())):
            out = out.append_column(name, pa.array([], type_))
        return out

    return asked.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(
        find, f"id {kind}, occurrence long, shard int, first long, offset long, n_tokens long")


def documents_of(table: DataFrame) -> DataFrame:
    """``(shard, offset, ids_crc32)`` of each document, read from the payload: the CRC of
    its ids as little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, first, width = (batch.column(c)[k].as_py() for c in range(3))
                ids = np.frombuffer(batch.column(3)[k].as_buffer(), _TYPES[width]).astype("<u4")
                ends = np.cumsum(np.frombuffer(batch.column(4)[k].as_py(), "<i8"))
                starts = np.append(0, ends[:-1])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ends), shard, np.int32)), pa.array(first + starts),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)], pa.int64())], ["shard", "offset", "ids_crc32"])

    return table.select("shard", "first", "width", "ids", "lengths").mapInArrow(read, "shard int, offset long, ids_crc32 long")


def fetch(keys: DataFrame, folder: str) -> DataFrame:
    """``(id, occurrence, ids)`` for ``(id, occurrence)`` keys: the index names the row of ids
    that holds each. The first document of an id has occurrence 0."""
    spark = keys.sparkSession
    found = locate(keys, index(spark, folder))
    located = found.join(payload(spark, folder).select("shard", "first", "width", "ids"), ["shard", "first"])
    size = F.col("width").cast("long")
    cut = located.select("id", "occurrence", "width", F.substring(
        "ids", ((F.col("offset") - F.col("first")) * size + 1).cast("int"), (F.col("n_tokens") * size).cast("int")).alias("raw"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                [np.frombuffer(x, _TYPES[w]).astype(np.int64) for w, x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())],
                pa.list_(pa.int64()))], ["id", "occurrence", "ids"])

    return cut.mapInArrow(read, f"id {_kind(keys, 'id')}, occurrence long, ids array<long>")


def write_tokens(documents: DataFrame, folder: str, tokenizer: str, end_id: int, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """Write payload and index of the documents, and return what the files hold:
    ``(id, start, n_tokens, ids_crc32)`` of each, found through the index.

    Null and empty texts have the end id alone. Repeated rows and ids are documents of
    their own; an empty table gives empty files. Other columns are ignored.
    """
    spark = documents.sparkSession
    table = write_payload(documents, folder, tokenizer, end_id, id_column, text_column)
    starts = shard_starts(spark, folder)
    entries = written(numbered(directory(table), starts), "entries")
    known = write_index(entries, folder)
    found = locate(entries.select("id", "occurrence"), known)
    return found.join(documents_of(table), ["shard", "offset"]).join(starts, "shard").select(
        "id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
