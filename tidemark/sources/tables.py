"""Catalog tables and small row relations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.partitioning import Partitioning
from tidemark.operators.transform import project
from tidemark.operators.watermark import Watermark


def scan(
    spark: SparkSession,
    name: str,
    columns: Iterable[str] | None = None,
    watermark: Watermark | None = None,
    partition: Partitioning | None = None,
) -> DataFrame:
    """A catalog table; columns, watermark and its implied partition predicate
    all end up in the file scan."""
    df = spark.table(name)
    if watermark:
        df = watermark.newer(df, partition)
    if partition:
        df = partition.drop_from(df)
    return project(df, columns)


def row(spark: SparkSession, values: Sequence, schema: T.StructType) -> DataFrame:
    """One row of literals: a projection, so no Python worker is involved."""
    literals = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, schema.fields, strict=True)]
    return spark.range(1).select(*literals)


def rows(spark: SparkSession, values: Iterable, schema) -> DataFrame:
    """Rows held by the driver (a run record, seed rows) under a declared schema;
    inference would fail on columns that are all NULL."""
    return spark.createDataFrame(list(values), schema)
