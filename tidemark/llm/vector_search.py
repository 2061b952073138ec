"""Exact top-k by inner product with a pivot-distance index.

Each vector is kept with its nearest pivot and its distance from it, in rings of the
pivot. A vector's distance from a query is at least the difference of their distances
from the pivot, so by the triangle inequality the inner products of a ring are bounded.

A query visits rings in order of their bounds, a few in the first round and more in each
further one; its k-th best score so far grows from round to round, and it stops before the
first ring whose bound is below it. Within a ring vectors are sorted by distance: the
search begins at the query's own distance, goes outward on both sides, and stops on a side
when no vector further out can have a better score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.folders import drop_written, written
from tidemark.llm.text import bounded_batches, give_back

#: Vectors for each pivot, most pivots, rings of a pivot, and the sample of the first scores.
PIVOT_VECTORS, MAX_PIVOTS, RINGS, SAMPLE = 8_192, 256, 8, 2_048
#: Vectors and queries that meet in one task.
BLOCK_VECTORS, BLOCK_QUERIES = 32_768, 4_096
#: Rings that a query visits in the first round, and how many times as many in each further one.
FIRST_RINGS, MORE = 4, 4
#: Queries that go outward together, and vectors of a step.
_CHUNK, _STEP = 256, 4_096
#: Distances are computed in doubles, as differences of squares: bounds are wider by this share of the squares.
_SLACK = 1e-6
_NONE = np.iinfo(np.int64).min


class ScoreError(ValueError):
    """A score does not fit 64 bits."""


def _encoded(values: np.ndarray) -> bytes:
    """Integers of a vector, in four or eight bytes each, with that number before them."""
    width = 4 if not len(values) or np.abs(values).max() < 1 << 31 else 8
    return bytes([width]) + values.astype(f"<i{width}").tobytes()


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros: doubles, or integers where doubles are not exact."""
    rows = column.to_pylist()
    if all(len(x) == 1 + 4 * dimension and x[0] == 4 for x in rows):
        data = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), 1 + 4 * dimension)
        return np.ascontiguousarray(data[:, 1:]).view("<i4").reshape(len(rows), dimension).astype(np.float64)
    out = np.zeros((len(rows), dimension), np.int64)
    for k, x in enumerate(rows):
        values = np.frombuffer(x, f"<i{x[0]}", offset=1)
        out[k, :len(values)] = values
    return out.astype(np.float64) if np.abs(out).max(initial=0) < 1 << 53 else out


def _scores(a: np.ndarray, b: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact inner products of rows, _NONE for the pairs marked ``own``. One that 64 bits don't hold is an error."""
    largest = [max(int(np.abs(x).max(initial=0)), 1) for x in (a, b)]
    most = largest[0] * largest[1] * max(a.shape[1], 1)
    if most < 1 << 53:
        out = (a @ b.T).astype(np.int64)
    elif most < 1 << 63:
        out = a.astype(np.int64) @ b.astype(np.int64).T
    else:
        exact = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
        exact[own] = 0
        if exact.size and max(exact.max(), -exact.min()) >= 1 << 63:
            raise ScoreError("a score does not fit 64 bits: scale the vectors down")
        out = exact.astype(np.int64)
    out[own] = _NONE
    return out


def _squares(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return (x * x).sum(1)


def quantised(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``(id, v, n)`` with v the n integers floor(scale * x); vectors that are null or hold a
    null or non-finite component are left out. A component beyond 64 bits is an error."""
    source = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v")).where("id is not null and v is not null")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            bad = np.append(0, np.cumsum(~np.isfinite(flat)))
            good = np.flatnonzero(bad[ends[1:]] == bad[ends[:-1]])
            with np.errstate(over="ignore"):
                values = np.floor(scale * np.where(np.isfinite(flat), flat, 0))
            beyond = np.append(0, np.cumsum(np.abs(values) >= 2.0**63))
            if (beyond[ends[1:]] != beyond[ends[:-1]])[good].any():
                raise ScoreError("a component does not fit 64 bits: scale the vectors down")
            whole = np.where(np.abs(values) < 2.0**63, values, 0).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(good)), pa.array([_encoded(whole[ends[k]:ends[k + 1]]) for k in good], pa.binary()),
                pa.array((ends[good + 1] - ends[good]).astype(np.int32))], ["id", "v", "n"])

    return source.mapInArrow(read, f"id {source.schema['id'].dataType.simpleString()}, v binary, n int")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def _bound(square: np.ndarray, other: np.ndarray | float, away: np.ndarray) -> np.ndarray:
    """The highest inner product of vectors whose distance is ``away`` or more; at least that, whatever was rounded."""
    return (square + other - away * away) / 2 + _SLACK * (square + other) + 1


class _Ring:
    """Vectors of a ring in order of their distance from the pivot."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, distance: np.ndarray, square: np.ndarray):
        order = np.argsort(distance, kind="stable")
        self.x, self.ids, self.distance = x[order], ids[order], distance[order]
        square = square[order]
        self.below = np.maximum.accumulate(square)  # the largest square from the first vector to each
        self.above = np.maximum.accumulate(square[::-1])[::-1]

    def search(self, q: np.ndarray, own: np.ndarray, from_pivot: np.ndarray, least: np.ndarray, k: int) -> tuple[list, list, int]:
        """Ids and scores of the best of each query, as far as they may be among its k best,
        and how many pairs were compared. ``least``: k-th best scores known before."""
        square, n, compared = _squares(q), len(self.ids), 0
        ids, scores = [np.empty(0, self.ids.dtype)] * len(q), [np.empty(0, np.int64)] * len(q)
        kth = least.astype(np.float64).copy()
        middle = float(np.median(from_pivot))
        low = high = int(np.searchsorted(self.distance, middle))
        inward, outward = low > 0, high < n
        while inward or outward:
            down = inward and (not outward or middle - self.distance[low - 1] <= self.distance[high] - middle)
            if down:
                a, b, nearest, largest = max(0, low - _STEP), low, self.distance[low - 1], self.below[low - 1]
                away = np.maximum(from_pivot - nearest, 0)
            else:
                a, b, nearest, largest = high, min(n, high + _STEP), self.distance[high], self.above[high]
                away = np.maximum(nearest - from_pivot, 0)
            some = np.flatnonzero(_bound(square, largest, away) >= kth)
            if not len(some):  # nor can anything further out on this side
                inward, outward = (False, outward) if down else (inward, False)
                continue
            found = _scores(q[some], self.x[a:b], own[some][:, None] == self.ids[a:b][None])
            compared += found.size
            for row, mine in zip(some, found):
                better = np.flatnonzero((mine >= kth[row]) & (mine != _NONE))
                if len(better):
                    together, names = np.append(scores[row], mine[better]), np.append(ids[row], self.ids[a:b][better])
                    best = _best(together, names, k)
                    ids[row], scores[row] = names[best], together[best]
                    if len(best) == k:
                        kth[row] = max(kth[row], float(together[best[-1]]))
            if down:
                low, inward = a, a > 0
            else:
                high, outward = b, b < n
        return ids, scores, compared


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
          scale: int = 256, compared: Accumulator | None = None) -> DataFrame:
    """``(query_id, rank, id, score)``: for each query the k rows of ``vectors`` with the
    highest inner products of values floor(scale * x), ties to smaller ids; ids are integers.

    Rows of the query's own id are no candidates. Vectors that are null or hold a null or
    non-finite component take no part, nor do rows without an id; a score that 64 bits don't
    hold is an error. A shorter vector counts as filled up with zeros. Repeated candidates
    count each; equal query rows are one. No vectors, or no queries, give no rows.

    ``compared`` gets the number of pairs whose score was computed.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    base = written(quantised(vectors, id_column, vector_column, scale), "vectors")
    total, widest = base.agg(F.count("*"), F.max("n")).first()
    dimension = int(widest or 0)
    sample = base.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).toArrow()
    seeds, seed_ids = _matrix(sample.column("v"), dimension), sample.column("id").to_numpy()
    pivots = np.unique(seeds, axis=0).astype(np.float64)
    pivots = pivots[np.random.default_rng(1).permutation(len(pivots))][:min(MAX_PIVOTS, total // PIVOT_VECTORS + 1)]
    if not len(pivots):
        pivots = np.zeros((1, dimension))
    sent = spark.sparkContext.broadcast((pivots, seeds, seed_ids))

    def distances(x: np.ndarray) -> np.ndarray:
        points, x = sent.value[0], x.astype(np.float64)
        square = (x * x).sum(1)[:, None] + (points * points).sum(1)[None] - 2 * (x @ points.T)
        return np.sqrt(np.maximum(square, 0))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dimension)
            d = distances(x)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(near)), near]), pa.array(_squares(x))],
                ["id", "v", "pivot", "distance", "square"])

    kind = base.schema["id"].dataType.simpleString()
    index = written(base.select("id", "v").mapInArrow(keyed, f"id {kind}, v binary, pivot int, distance double, square double"), "index")
    drop_written(base)
    steps = [k / RINGS for k in range(1, RINGS)]
    cuts = index.groupBy("pivot").agg(F.percentile_approx("distance", steps, 1000).alias("cuts"))
    cuts = {r["pivot"]: r["cuts"] for r in cuts.collect()}
    ring_cuts = spark.createDataFrame(sorted(cuts.items()), "pivot int, cuts array<double>")
    # one row for each pivot: at most MAX_PIVOTS
    index = index.join(F.broadcast(ring_cuts), "pivot").withColumn(
        "cell", F.col("pivot") * RINGS + F.size(F.filter("cuts", lambda c: c < F.col("distance")))).drop("cuts")
    # one row for each ring: at most MAX_PIVOTS * RINGS
    cells = index.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high"), F.max("square").alias("square")).orderBy("cell").collect()
    shape = {name: np.array([r[name] for r in cells], float) for name in ("cell", "n", "low", "high", "square")}
    known = spark.sparkContext.broadcast(shape)

    def first_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k-th best score of each query among the sample."""
        _, seeds, seed_ids = sent.value
        for batch in batches:
            x, ids = _matrix(batch.column(1), dimension), batch.column(0).to_numpy()
            scores = _scores(x, seeds, ids[:, None] == seed_ids[None])
            least = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(x), _NONE)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(least)], ["query_id", "q", "least"])

    def visits(first: int, after: int):
        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The rings of a round, of those whose bound allows a better score."""
            cells = known.value
            pivot = cells["cell"].astype(np.int64) // RINGS
            for batch in batches:
                x, least = _matrix(batch.column(1), dimension), batch.column(2).to_numpy().astype(np.float64)
                d = distances(x)
                away = np.maximum(np.maximum(cells["low"][None] - d[:, pivot], d[:, pivot] - cells["high"][None]), 0)
                bound = _bound(_squares(x)[:, None], cells["square"][None], away)
                order = np.argsort(-bound, axis=1, kind="stable")[:, first:after]
                row = np.repeat(np.arange(len(x)), order.shape[1])
                cell = order.ravel()
                some = bound[row, cell] >= least[row]
                row, cell = row[some], cell[some]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(cells["cell"][cell].astype(np.int32)),
                    pa.array(d[row, pivot[cell]]), batch.column(2).take(pa.array(row))], ["query_id", "q", "cell", "from_pivot", "least"])

        return visit

    def meet(asked: pa.Table, there: pa.Table) -> pa.Table:
        row, ids, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if asked.num_rows and there.num_rows:
            ring = _Ring(_matrix(there.column("v"), dimension), there.column("id").to_numpy(), there.column("distance").to_numpy(), there.column("square").to_numpy())
            asked = asked.sort_by("from_pivot")
            q, own, from_pivot, least = (_matrix(asked.column("q"), dimension), asked.column("query_id").to_numpy(),
                                         asked.column("from_pivot").to_numpy(), asked.column("least").to_numpy())
            for at in range(0, len(q), _CHUNK):
                part = slice(at, at + _CHUNK)
                found, values, pairs = ring.search(q[part], own[part], from_pivot[part], least[part], k)
                if compared is not None:
                    compared.add(pairs)
                row += [np.full(len(x), at + n) for n, x in enumerate(found)]
                ids += found
                scores += values
        give_back()
        take = pa.array(np.concatenate(row).astype(np.int64))
        return pa.table({"query_id": asked.column("query_id").take(take), "q": asked.column("q").take(take),
                         "id": pa.array(np.concatenate(ids), there.column("id").type), "score": pa.array(np.concatenate(scores).astype(np.int64))})

    state = written(quantised(queries, id_column, vector_column, scale).select("id", "v").distinct().mapInArrow(
        first_scores, f"query_id {kind}, q binary, least long"), "queries")
    found, first, size = None, 0, FIRST_RINGS
    ranked = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "id"))
    while first < len(cells):
        asked = written(state.mapInArrow(visits(first, first + size), f"query_id {kind}, q binary, cell int, from_pivot double, least long"), "asked")
        # one row for each ring
        number = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        first, size = first + size, size * MORE
        if not number:
            break  # no query has a ring left: they are in order of their bounds
        met = _met(asked, index, shape, number, spark).applyInArrow(meet, f"query_id {kind}, q binary, id {kind}, score long")
        best = met if found is None else met.unionByName(found)
        best = best.withColumn("rank", ranked).where(F.col("rank") <= k)
        found = written(best.select("query_id", "q", "id", "score"), "found")
        drop_written(asked)
        kth = found.groupBy("query_id", "q").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k).select(
            F.col("query_id").alias("i"), F.col("q").alias("v"), "kth")
        state = written(state.join(kth, (F.col("query_id") == F.col("i")) & (F.col("q") == F.col("v")), "left").select(
            "query_id", "q", F.greatest("least", "kth").alias("least")), "queries")
    if found is None:
        return state.select("query_id", F.lit(1).alias("rank"), F.col("query_id").alias("id"), F.col("least").alias("score")).limit(0)
    return found.withColumn("rank", ranked).select("query_id", "rank", "id", "score")


def _met(asked: DataFrame, index: DataFrame, shape: dict, number: dict, spark):
    """Queries and vectors of each ring, brought together. A large ring and its queries meet block by block."""
    grid = F.broadcast(spark.createDataFrame(
        [(int(c), max(1, -(-int(n) // BLOCK_VECTORS)), max(1, -(-number[int(c)] // BLOCK_QUERIES))) for c, n in zip(shape["cell"], shape["n"]) if int(c) in number],
        "cell int, vector_blocks int, query_blocks int"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(grid, "cell").withColumn("qb", F.pmod(F.xxhash64("query_id"), F.col("query_blocks")).cast("int")).withColumn("vb", spread("vector_blocks"))
    right = index.join(grid, "cell").withColumn("vb", F.pmod(F.xxhash64("id", F.lit(1)), F.col("vector_blocks")).cast("int")).withColumn("qb", spread("query_blocks"))
    keys = ["cell", "qb", "vb"]
    return left.select("query_id", "q", "from_pivot", "least", *keys).groupBy(*keys).cogroup(
        right.select("id", "v", "distance", "square", *keys).groupBy(*keys))
