"""Jaccard self-join of documents on word n-grams, by vertical partitioning.

N-grams have a global order: how many documents hold them (as a power of two), then
hash. The order is cut into fragments, and each document into segments, one for each
fragment. What two documents share is counted in each fragment separately, and the
counts are summed per pair.

Which pairs are counted, without losing one that reaches the threshold:

1. Documents of equal sets are one text.
2. A text can only be linked if enough of its n-grams occur in another text. This is
   asked of its first n-grams by hash, and of those left, of all their n-grams. Hash
   ranges are dealt to tasks, each of which gets a distinct n-gram once from every
   batch of documents, so frequent n-grams weigh no more than others there.
3. Linked texts share one of their first n-grams in the global order. In each list of
   texts with such an n-gram all are first counted against the list's smallest text.
   What that links needs no further count among itself: afterwards only pairs of
   different components are counted, so large groups of copies never become all pairs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import stars
from tidemark.llm.folders import drop_written, written
from tidemark.llm.text import NON_SPACE, U64, Block, blocks, bounded_batches, grams, mix, ranges

#: Ids up to this number (some 20 MB) are broadcast to find or drop their rows; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: N-grams for a task that looks for shared ones.
TASK_GRAMS = 4_000_000
#: Rounds in which the texts of a list are counted against a few of them, and how many those are.
STAR_ROUNDS, STAR_CENTRES = 2, 3
#: Bytes of text that make one batch.
BATCH_BYTES = 4 << 20


def _sets(block: Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each row in order of row and hash, and their number by row."""
    starts, ends, rows = block.words(NON_SPACE)
    words = block.hashes(starts, ends)
    value, at = grams(words, rows, n)
    value, owner = [value], [rows[at]]
    number = np.bincount(rows, minlength=len(block))
    for few in range(1, n):
        short = np.flatnonzero(number[rows] == few)
        if len(short):
            found, first = grams(words[short], rows[short], few)
            value.append(found)
            owner.append(rows[short][first])
    value, owner = np.concatenate(value), np.concatenate(owner)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(block))


def _set_keys(value: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 bits for each set, whatever its order."""
    ends = np.cumsum(sizes)
    out = np.zeros((len(sizes), 2), U64)
    for k, salt in enumerate((7, 0x5851F42D4C957F2D)):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(value ^ U64(salt)))])
        out[:, k] = mix((total[ends] - total[ends - sizes]) ^ sizes.astype(U64))
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.dtype.itemsize * rows.shape[1]
    data = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(data)]).cast(pa.binary())


def _pieces(values: np.ndarray, ends: np.ndarray) -> list[bytes]:
    return [values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]


def _ends(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])


def batch_table(documents: DataFrame, n: int, whole: bool) -> DataFrame:
    """Documents ``(id, text)`` packed into rows of many, each with a name of its own: ids,
    sizes and 128-bit keys of their sets, and n-grams: all, or those the first test takes."""
    kind = documents.schema["id"].dataType

    def taken(value: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if whole:
            return value, sizes
        counts = np.minimum(sizes, sizes // 5 + 1 + sizes // 10)
        again = np.ones(len(sizes), bool)
        again[np.unique(keys[:, 0], return_index=True)[1]] = False
        counts[(sizes == 0) | again] = 0
        return value[ranges(_ends(sizes)[:-1], counts)], counts

    def pack(ids: pa.Array, found: list) -> pa.RecordBatch:
        sizes, keys, counts, value = (np.concatenate(x) for x in zip(*found))
        return pa.RecordBatch.from_pydict({
            "batch": pa.array([uuid.uuid4().hex]),
            "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            "sizes": pa.array([sizes.tobytes()], pa.binary()), "keys": pa.array([keys.tobytes()], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()), "grams": pa.array([value.tobytes()], pa.binary())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, size = [], [], 0
        for batch in batches:
            for block in blocks(batch.column(1)):
                value, sizes = _sets(block, n)
                keys = _set_keys(value, sizes)
                value, counts = taken(value, sizes, keys)
                ids.append(batch.column(0).slice(block.first, len(block)))
                found.append((sizes, keys, counts, value))
                size += len(block.data)
                if size >= BATCH_BYTES:
                    yield pack(pa.concat_arrays(ids), found)
                    ids, found, size = [], [], 0
        if found:
            yield pack(pa.concat_arrays(ids), found)

    return documents.select("id", "text").mapInArrow(
        read, f"batch string, ids array<{kind.simpleString()}>, sizes binary, keys binary, counts binary, grams binary")


def document_table(batches: DataFrame) -> DataFrame:
    """``(id, n_grams, key)`` of the documents in batches."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for k in range(batch.num_rows):
                keys = np.frombuffer(batch.column(2)[k].as_py(), U64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[k].values, pa.array(np.frombuffer(batch.column(1)[k].as_py(), np.int64)), _binary(keys)],
                    ["id", "n_grams", "key"])

    kind = batches.schema["ids"].dataType.elementType.simpleString()
    return batches.select("ids", "sizes", "keys").mapInArrow(read, f"id {kind}, n_grams long, key binary")


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["keys"], U64).reshape(-1, 2), np.frombuffer(row["sizes"], np.int64),
            np.frombuffer(row["counts"], np.int64), np.frombuffer(row["grams"], U64))


def _runs(value: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(value):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(value[1:] != value[:-1]) + 1, [len(value)]])


def _distinct(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams, one owner of each (0 if there are several), and their number of texts."""
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    first = _runs(value)[:-1]
    if not len(value):
        return value, owner, first
    low, high = np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first)
    return value[first], np.where(low == high, low, U64(0)), np.diff(np.concatenate([first, [len(value)]]))


def _levels(batches: DataFrame, fragments: int) -> DataFrame:
    """``(batch, levels)``: for the distinct n-grams of a batch in order of hash, 0 if no
    other text has it, else 1 + log2 of the number of texts.

    A fragment of the hash range gets each distinct n-gram once from every batch. It
    compares 32 more bits of an n-gram: what agrees by chance only passes a filter.
    """

    def deal(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                keys, _, counts, value = _unpack(row)
                value, owner, number = _distinct(value, np.repeat(keys[:, 0], counts))
                part = (value >> U64(32)) * U64(fragments) >> U64(32)
                cuts = _runs(part)
                yield pa.RecordBatch.from_pydict({
                    "fragment": pa.array(part[cuts[:-1]].astype(np.int32)), "batch": pa.array([row["batch"]] * (len(cuts) - 1), pa.string()),
                    "grams": pa.array(_pieces(value.astype(np.uint32), cuts), pa.binary()), "owners": pa.array(_pieces(owner, cuts), pa.binary()),
                    "numbers": pa.array(_pieces(number.astype(np.uint32), cuts), pa.binary()),
                })

    def count(table: pa.Table) -> pa.Table:
        lists = table.column("grams").to_pylist()
        value = np.frombuffer(b"".join(lists), np.uint32)
        owner = np.frombuffer(b"".join(table.column("owners").to_pylist()), U64)
        number = np.frombuffer(b"".join(table.column("numbers").to_pylist()), np.uint32)
        order = np.argsort(value, kind="stable")
        value, owner, number = value[order], owner[order], number[order]
        runs = _runs(value)
        low, high = np.minimum.reduceat(owner, runs[:-1]), np.maximum.reduceat(owner, runs[:-1])
        total = np.add.reduceat(number.astype(np.int64), runs[:-1])
        level = np.where((low != high) | (low == 0), 1 + np.floor(np.log2(np.maximum(total, 2))), 0).astype(np.uint8)
        out = np.empty(len(value), np.uint8)
        out[order] = np.repeat(level, np.diff(runs))
        return pa.table({"fragment": table.column("fragment"), "batch": table.column("batch"),
                         "levels": pa.array(_pieces(out, _ends([len(x) // 4 for x in lists])), pa.binary())})

    dealt = batches.select("batch", "keys", "sizes", "counts", "grams").mapInArrow(
        deal, "fragment int, batch string, grams binary, owners binary, numbers binary")
    return dealt.groupBy("fragment").applyInArrow(count, "fragment int, batch string, levels binary")


def _with_levels(batches: DataFrame, fragments: int) -> DataFrame:
    parts = _levels(batches, fragments).groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct("fragment", "levels"))).alias("parts"))
    return batches.drop("ids").join(parts, "batch").withColumn("levels", F.col("parts.levels")).drop("parts")


def _filtered(batches: DataFrame, fragments: int, whole: bool) -> DataFrame:
    """Texts of which enough n-grams occur in another text.

    ``whole``: all n-grams were given, and the result has the shared ones in the global
    order, with their levels; otherwise they are the first ones by hash.
    """

    def keep(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                keys, sizes, counts, value = _unpack(row)
                level = np.frombuffer(b"".join(row["levels"]), np.uint8)[np.searchsorted(np.unique(value), value)]
                owner = np.repeat(np.arange(len(keys)), counts)
                shared = np.bincount(owner, level > 0, minlength=len(keys)).astype(np.int64)
                # Sets that reach 0.8 differ by at most a fifth in size; the shorter list decides.
                kept = shared * 5 >= sizes * 4 if whole else shared >= 1 + (4 * sizes + 4) // 5 // 10
                kept &= shared > 0
                mine = kept[owner] & (level > 0)
                value, level, owner = value[mine], level[mine], owner[mine]
                if whole:
                    order = np.lexsort((value, level, owner))
                    value, level = value[order], level[order]
                ends = _ends(shared[kept])
                yield pa.RecordBatch.from_arrays(
                    [_binary(keys[kept]), pa.array(sizes[kept]), pa.array(_pieces(value, ends), pa.binary()),
                     pa.array(_pieces(level, ends), pa.binary())], ["key", "n_grams", "grams", "levels"])

    return _with_levels(batches, fragments).mapInArrow(keep, "key binary, n_grams long, grams binary, levels binary")


def _segment_table(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments ``(node, n, fragment, grams)`` of each text, and ``(gram, node, n, place)``
    of its first shared n-grams in the global order."""

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                value, level = np.frombuffer(row["grams"], np.int64), np.frombuffer(row["levels"], np.uint8)
                part = level.astype(np.int32) * 4 + (value.view(U64) >> U64(62)).astype(np.int32)
                cuts = _runs(part)
                # n-grams of no other text come first in the global order
                alone = row["n_grams"] - len(value)
                firsts = np.clip(row["n_grams"] // 5 + 1 - alone - cuts[:-1], 0, np.diff(cuts))
                yield pa.RecordBatch.from_pydict({
                    "node": [row["key"]] * (len(cuts) - 1), "n": [row["n_grams"]] * (len(cuts) - 1),
                    "alone": [alone] * (len(cuts) - 1), "fragment": pa.array(part[cuts[:-1]]), "place": pa.array(alone + cuts[:-1]), "firsts": pa.array(firsts),
                    "grams": pa.array([value[a:b] for a, b in zip(cuts[:-1], cuts[1:])], pa.list_(pa.int64())),
                })

    segments = written(texts.mapInArrow(
        cut, "node binary, n long, alone long, fragment int, place long, firsts long, grams array<long>"), "segments")
    prefix = segments.where("firsts > 0").select(
        "node", "n", "alone", "place", F.posexplode(F.slice("grams", 1, F.col("firsts").cast("int"))).alias("at", "gram")
    ).select("gram", "node", "n", "alone", (F.col("place") + F.col("at")).alias("place"))
    return segments, prefix


def _fits(threshold: int) -> F.Column:
    """Whether sizes and places of a common n-gram, both sides known, still allow the threshold."""
    n, m = F.col("n"), F.col("m")
    left = F.least(n - F.col("place"), m - F.col("there"))
    return ((100 * F.least(n, m) >= threshold * F.greatest(n, m))
            & ((100 + threshold) * left >= threshold * (n + m)))


def _counted(pairs: DataFrame, segments: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``(a, b)`` that reach the threshold, or what they link, ``(high, low)``, if
    pairs have that: overlaps of segments, summed per pair."""
    left = segments.select(F.col("node").alias("a"), F.col("n"), "fragment", F.col("grams").alias("one"))
    right = segments.select(F.col("node").alias("b"), F.col("n").alias("m"), "fragment", F.col("grams").alias("other"))
    linked = [c for c in ("high", "low") if c in pairs.columns]
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select(
        "a", "b", "n", "m", *linked, F.size(F.array_intersect("one", "other")).alias("common"))
    common = partial.groupBy("a", "b").agg(F.sum("common").alias("common"), *[F.first(c).alias(c) for c in ("n", "m", *linked)])
    found = common.where((100 + threshold) * F.col("common") >= threshold * (F.col("n") + F.col("m")))
    if not linked:
        return found.select("a", "b")
    return found.select(F.col("high").alias("a"), F.col("low").alias("b")).distinct()


def linked_texts(texts: DataFrame, threshold: int) -> DataFrame:
    """``(node, component)`` of the texts that are linked with a smaller one."""
    segments, prefix = _segment_table(texts)
    lists = prefix = written(prefix, "prefix")
    nodes = None
    for turn in range(STAR_ROUNDS):
        found, number = stars(_counted(written(_stars(lists, turn, threshold), "stars"), segments, threshold))
        nodes = found if nodes is None else _joined(nodes, found, number)
        if number:
            # Components only grow: lists of one component need no further count.
            lists = written(_mixed(_labelled(lists, found)), "open")
    pairs = _pairs(lists.join(_others(lists), "gram"), "<", threshold)
    nodes = _joined(nodes, *stars(_counted(written(pairs, "cross"), segments, threshold)))
    return nodes.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _joined(nodes: DataFrame, found: DataFrame, number: int) -> DataFrame:
    """Stars ``(a, b)`` of texts, and of their components, as stars of texts."""
    if not number:
        return nodes
    more = found.select(F.col("a").alias("was"), F.col("b").alias("now"))
    return nodes.join(more, F.col("b") == F.col("was"), "left").select("a", F.coalesce("now", "b").alias("b")).unionByName(found)


def _labelled(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Lists with the components that stars ``(a, b)`` make of the texts, or of earlier components."""
    earlier = F.col("component" if "component" in lists.columns else "node")
    joined = lists.join(found.select(F.col("a").alias("was"), F.col("b").alias("now")), earlier == F.col("was"), "left")
    return joined.withColumn("component", F.coalesce("now", earlier)).drop("was", "now")


def _mixed(labelled: DataFrame) -> DataFrame:
    """Lists of n-grams with texts of several components."""
    mixed = labelled.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return labelled.join(mixed.where("low <> high").select("gram"), "gram")


def _others(rows: DataFrame) -> DataFrame:
    """Rows of lists under the names of a pair's second text."""
    names = {"node": "b", "n": "m", "place": "there", "component": "its"}
    return rows.select("gram", *[F.col(c).alias(names[c]) for c in rows.columns if c in names])


def _pairs(joined: DataFrame, order: str, threshold: int) -> DataFrame:
    """Pairs ``(a, b)`` that may reach the threshold, of texts of different components in the
    given order, with these as ``(high, low)``; before any are known each text is its own."""
    ends = [F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")]
    if "component" not in joined.columns:
        return joined.where(f"node {order} b").where(_fits(threshold)).select(ends).distinct()
    return joined.where(f"component {order} its").where(_fits(threshold)).select(
        *ends, F.greatest("component", "its").alias("high"), F.least("component", "its").alias("low")).distinct()


def _stars(lists: DataFrame, turn: int, threshold: int) -> DataFrame:
    """Pairs ``(a, b)`` of each text in a list with a few of the list: the one with the
    smallest share of n-grams that no other text has, as copies differ from their
    original in such, and some that a hash picks."""
    ranks = [F.col("alone") / F.col("n")] + [F.lit(0.0)] * (STAR_CENTRES - 1)
    row = [c for c in lists.columns if c not in ("gram", "alone")]
    picked = lists.groupBy("gram").agg(*[
        F.min(F.struct(rank.alias("r"), F.xxhash64("node", F.lit(STAR_CENTRES * turn + k)).alias("h"), *row))
        .alias(f"s{k}") for k, rank in enumerate(ranks)])
    centres = picked.select("gram", F.explode(F.array(*[f"s{k}" for k in range(STAR_CENTRES)])).alias("s")).select("gram", "s.*")
    return _pairs(lists.join(_others(centres), "gram"), "<>", threshold)


def _classes(documents: DataFrame, id_column: str, text_column: str, n: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """``(id, n_grams, key)`` of each document, and ``(key, id, component)`` of each set
    that is not empty; id is the smallest one with the set."""
    if threshold < 80 or threshold > 100:
        raise ValueError("threshold must be 80 to 100")
    bounded_batches(documents.sparkSession)
    source = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    batches = written(batch_table(source, n, False), "batches")
    sets = written(document_table(batches), "sets")
    ids = sets.where("n_grams > 0").groupBy("key").agg(F.min("id").alias("id"))
    first = _filtered(batches, _fragments(batches), False).select("key")
    chosen = written(ids.join(first, "key", "left_semi"), "chosen")
    drop_written(batches)
    wanted = chosen.select(F.col("id").alias("wanted")).distinct()
    if chosen.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = source.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")
    batches = written(batch_table(texts, n, True), "batches")
    known = _filtered(batches, _fragments(batches), True)
    # An id may stand for several rows; equal sets are one text.
    nodes = linked_texts(known.dropDuplicates(["key"]), threshold)
    drop_written(batches)
    member = ids.join(nodes, ids["key"] == nodes["node"], "left").select(
        "key", "id", F.coalesce("component", "key").alias("component"))
    return sets, member


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    n: int = 5, threshold: int = 80) -> DataFrame:
    """``(id, n_shingles, component_id)`` for each document.

    Two documents are linked if ``100 * |A and B| >= threshold * |A or B|`` for their
    sets of n-grams of words (A-Z lower-cased, cut at white space). A text of fewer words
    is one n-gram; a null, empty or blank text has none and is linked with nothing.
    ``component_id`` is the smallest id reachable by links. Repeated rows and equal ids
    are allowed: every row gets its own result. A null id is never a component's
    smallest unless its members have none else. Other columns are ignored.

    The filters hold for thresholds of 80 and more. N-grams are compared by 64-bit hashes.
    """
    sets, member = _classes(documents, id_column, text_column, n, threshold)
    smallest = member.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = member.join(smallest, "component").select("key", "component_id")
    return sets.join(classes, "key", "left").select(
        "id", F.col("n_grams").alias("n_shingles"),
        F.when(F.col("n_grams") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def deduplicate(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                n: int = 5, threshold: int = 80) -> DataFrame:
    """The documents, of each component of ``near_duplicates`` only one, with all columns.

    The one with the smallest id stays. Texts without words are linked with nothing and
    all stay. Of rows that share their id and set, one stays.
    """
    sets, member = _classes(documents, id_column, text_column, n, threshold)
    kept = member.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("k")).select(
        F.col("k.id").alias("kept_id"), F.col("k.key").alias("kept_key"))
    kept = written(kept.unionByName(sets.where("n_grams = 0").select(F.col("id").alias("kept_id"), F.lit(None).cast("binary").alias("kept_key"))), "kept")
    row = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.struct("*").alias("row"))
    same = F.col("id").eqNullSafe(F.col("kept_id"))
    again = sets.groupBy(F.col("id").alias("again")).count().where("count > 1 or again is null").select("again")
    if not again.head(1):
        # Fewer go than stay, so it is their ids that meet the rows.
        dropped = written(sets.join(kept, same, "left_anti").select(F.col("id").alias("dropped")), "dropped")
        if dropped.count() <= BROADCAST_IDS:
            dropped = F.broadcast(dropped)
        return row.join(dropped, F.col("id") == F.col("dropped"), "left_anti").select("row.*")
    # Ids of several rows don't tell which of them to keep; their sets do.
    again = written(again, "again")
    repeated = F.col("id").eqNullSafe(F.col("again"))
    plain = row.join(again, repeated, "left_anti").join(kept, same, "left_semi").select("row")
    keyed = _keyed(row.join(again, repeated, "left_semi"), n)
    empty = keyed.where("n_grams = 0").select("row")
    chosen = keyed.where("n_grams > 0").join(kept, same & (F.col("key") == F.col("kept_key")), "left_semi")
    return plain.unionByName(empty).unionByName(chosen.dropDuplicates(["id", "key"]).select("row")).select("row.*")


def _keyed(rows: DataFrame, n: int) -> DataFrame:
    """``(id, text, row)`` with ``n_grams`` and ``key`` of each text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                value, sizes = _sets(block, n)
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("row"), pa.array(sizes.astype(np.int64)), _binary(_set_keys(value, sizes))],
                    ["id", "row", "n_grams", "key"])

    schema = rows.select("id", "row").schema.add("n_grams", "long").add("key", "binary")
    return rows.mapInArrow(read, schema)


def _fragments(batches: DataFrame) -> int:
    """So many hash ranges that each has TASK_GRAMS n-grams at most, and every shuffle task has one."""
    grams = batches.agg(F.sum(F.length("grams") / 8)).first()[0] or 0
    return max(int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(grams // TASK_GRAMS) + 1)
