"""Places for what a job writes between its steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks.places import delete_path, fresh_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the cluster's shared folder: computed once, kept if executors are lost."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def drop_written(table: DataFrame) -> None:
    """Free the space of a table that ``written`` made and nothing reads any more."""
    delete_path(table.sparkSession, table.written_path)


def folder(spark: SparkSession, name: str) -> str:
    return fresh_folder(spark, name)
