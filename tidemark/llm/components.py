"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.folders import written


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of a node (the larger ones, or else the smaller ones) to the
    smallest node around. The minimum is taken before the join, so a node with very
    many neighbours is combined early and its rows may be split. Edges may be repeated."""
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = edges.join(least, "a")
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    moved = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
    return joined.select(moved.alias("e")).select("e.*").where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    """The number of edges, and of nodes that keep them from being stars around smallest nodes:
    those with several smaller neighbours, or with both smaller and larger ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("centre")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("centre").alias("centre"))
    row = nodes.agg(F.sum("up"), F.count_if(F.expr("up + centre > 1 and up > 0"))).first()
    return row[0] or 0, row[1]


def stars(edges: DataFrame) -> tuple[DataFrame, int]:
    """``(a, b)`` for each node a that has a smaller one in its component, b being the
    smallest, and their number. Edges are distinct ``(a, b)`` with a > b.

    Large-star and small-star steps alternate until the edges are stars around the
    smallest nodes. Each step is written to the shared folder.
    """
    edges = written(edges, "edges")
    while True:
        number, others = _state(edges)
        if not others:
            return edges, number
        edges = written(_step(_step(edges, True), False), "edges")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of edges ``(a, b)``: the smallest node of its component.

    Loops, repeated edges and nulls are allowed: loops are dropped, nulls link nothing.
    """
    found, _ = stars(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    return found.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        found.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
