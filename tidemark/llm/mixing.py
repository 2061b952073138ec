"""Mixing sources to target weights, by histograms of hashes.

Each document has a hash. A source takes whole copies of all its documents, and of
one more copy those documents whose hash is below a threshold. The threshold comes
from sums of sizes by source and hash bucket: the bucket in which a source's budget
ends is cut into finer buckets, until it holds one hash. Nothing is sorted, and a
larger budget always takes what a smaller one takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.folders import written
from tidemark.llm.text import NON_SPACE, blocks, bounded_batches

#: Bits of a hash, and how many each level of buckets looks at.
HASH_BITS, LEVEL_BITS = 60, 12


def word_counts(documents: DataFrame, text_column: str = "text", name: str = "size") -> DataFrame:
    """The documents with their number of words between white space instead of the text; 0 for a null."""
    bounded_batches(documents.sparkSession)
    source = documents.withColumn("__text", F.col(text_column).cast("string")).drop(text_column, name)
    kept = [c for c in source.columns if c != "__text"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(batch.num_columns - 1)):
                starts, _, rows = block.words(NON_SPACE)
                part = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in range(len(kept))] + [pa.array(np.bincount(rows, minlength=len(block)).astype(np.int64))],
                    kept + [name])

    return source.mapInArrow(read, source.drop("__text").schema.add(name, "long"))


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources ``(source, n)`` with their place by code point, null last. They are sorted by
    ranges; the number of rows of each range, and nothing else, comes to the driver."""
    order = F.col("source").asc_nulls_last()
    placed = written(sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("at", 33).cast("int")
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = np.cumsum([0] + [n for _, n in sizes])
    # An Arrow table needs no Python workers: for a list Spark starts others than those of the operators, and keeps them.
    starts = placed.sparkSession.createDataFrame(pa.table({
        "part": pa.array([p for p, _ in sizes], pa.int32()), "before": pa.array(before[:-1], pa.int64())}))
    return placed.join(F.broadcast(starts), part == F.col("part")).select(
        "source", "n", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("place"))


def targets(sources: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """``(source, n, target)``: the words each source of ``(source, n)`` shall give.

    The sources, by code point, null last, have the weights in turn and share the sum of all
    sizes by weight; a source stops at ``repeats`` times its size, and what it can't give is
    shared again by the others. Each round finds, by one sum over the sources, which are
    full at the share of the last one; shares only grow, and after a few rounds no more get full.
    """
    place = F.pmod(F.col("place"), F.lit(len(weights))) + 1
    weighed = written(_numbered(sources).select("source", "n", F.element_at(F.array(*map(F.lit, weights)), place.cast("int")).alias("weight")), "weights")
    total, open_weight = weighed.agg(F.sum("n"), F.sum("weight")).first()
    left, most = float(total or 0), F.lit(repeats) * F.col("n")
    share = lambda: F.lit(left) * F.col("weight") / F.lit(open_weight)
    while open_weight:
        full = share() > most
        spent, rest = weighed.agg(F.sum(F.when(full, most).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if (float(total - spent), rest) == (left, open_weight):
            break
        left, open_weight = float(total - spent), rest
    return weighed.select("source", "n", F.least(share(), most).cast("double").alias("target") if open_weight else most.cast("double").alias("target"))


def _thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """``(source, below, edge)``: a source takes the hashes below, and that of the edge if it is not null."""
    state = budgets.select("source", F.lit(0).cast("long").alias("prefix"), F.col("budget").alias("left"))
    done = 0
    while done < HASH_BITS:
        done += LEVEL_BITS
        state = written(_finer(sized, state, done), "threshold")
    # The edge holds one hash. It is taken if that brings the source nearer to its budget.
    taken = F.when((F.col("left") > 0) & (2 * F.col("left") >= F.col("inside")), F.col("prefix"))
    return state.select("source", F.col("prefix").alias("below"), taken.alias("edge"))


def _finer(sized: DataFrame, state: DataFrame, bits: int) -> DataFrame:
    """Of each source's bucket, the finer bucket in which its budget ends."""
    rest = HASH_BITS - bits
    inside = sized.join(state.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")) & (
        F.shiftright("hash", rest + LEVEL_BITS) == F.col("prefix")))
    sums = inside.groupBy("source", F.shiftright("hash", rest).alias("bucket")).agg(
        F.sum("size").alias("inside"), F.first("left").alias("left"))
    ordered = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("upto", F.sum("inside").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    # The first bucket that reaches the budget, or the last one if sizes end before.
    reached = sums.groupBy("source").agg(
        F.min(F.when(F.col("upto") >= F.col("left"), F.struct("bucket", "upto", "inside", "left"))).alias("first"),
        F.max(F.struct("bucket", "upto", "inside", "left")).alias("last"))
    at = F.coalesce("first", "last")
    return reached.select("source", at["bucket"].alias("prefix"), (at["left"] - at["upto"] + at["inside"]).alias("left"),
                          at["inside"].alias("inside"))


def _hash(id_column: str, text_column: str) -> Column:
    key = F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def _plan(sized: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """``(s, source_size, target, whole, below, edge)`` of each source s."""
    wanted = targets(sized.groupBy("source").agg(F.sum("size").alias("n")), weights, repeats)
    whole = F.when(F.col("n") > 0, F.floor(F.col("target") / F.col("n"))).otherwise(0).cast("int")
    plan = wanted.select(F.col("source").alias("s"), F.col("n").alias("source_size"), "target", whole.alias("whole"))
    plan = written(plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    limits = _thresholds(sized, plan.where("budget > 0").withColumnRenamed("s", "source"))
    return written(plan.join(limits, F.col("source").eqNullSafe(F.col("s")), "left").drop("source", "budget"), "plan")


def _copies(hash_: Column) -> Column:
    return F.col("whole") + F.coalesce((hash_ < F.col("below")) | (hash_ == F.col("edge")), F.lit(False)).cast("int")


def mix(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """``(id, source, size, source_size, target, copies)`` of each document.

    Sources in order of code points, null last, have the weights in turn. ``target`` are
    the words the source shall give, ``copies`` how often the document is taken whole:
    0 to ``repeats`` times. A source's taken words differ from its target by half of one
    document's size at most; rows of equal id and text have one hash and go together.
    Null and empty texts have size 0 and are taken like others of their hash. A source
    of no words has target 0. The result depends on the rows alone, not on their order.
    """
    sized = _sized(documents, id_column, text_column, source_column)
    plan = _plan(sized, weights, repeats)
    return sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        "id", "source", "size", "source_size", "target", _copies(F.col("hash")).alias("copies"))


def _sized(documents: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    return written(word_counts(documents.select(
        F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"), F.col(text_column).cast("string").alias("text"),
        _hash(id_column, text_column).alias("hash"))), "sizes")


def taken(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
          weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """The documents that ``mix`` takes, with all columns, each as often as it is taken."""
    plan = _plan(_sized(documents, id_column, text_column, source_column), weights, repeats)
    rows = documents.select(F.struct("*").alias("row"), F.col(source_column).cast("string").alias("source"), _hash(id_column, text_column).alias("hash"))
    copies = rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).select("row", _copies(F.col("hash")).alias("copies"))
    return copies.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
