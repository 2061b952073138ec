"""Schema comparison and additive evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.columns import col, find_column, quoted
from tidemark.functions.types import verdict


class SchemaError(Exception):
    """The batch does not fit the target."""


def compare(source: T.StructType, target: T.StructType) -> list[tuple[str, str, str | None, str]]:
    """``(column, source type, target type, verdict)`` per source column; names
    match any case."""
    lines = []
    for field in source.fields:
        hit = find_column(target.names, field.name)
        known = target[hit].dataType if hit else None
        lines.append((
            field.name,
            field.dataType.simpleString(),
            known.simpleString() if known else None,
            verdict(field.dataType, known),
        ))
    return lines


def diff(spark: SparkSession, source: T.StructType, target: T.StructType) -> DataFrame:
    """``compare`` as a DataFrame."""
    return spark.createDataFrame(
        compare(source, target), "col string, source_type string, target_type string, verdict string"
    )


def additions(
    source: T.StructType, target: T.StructType, evolution: bool = True, add_columns: bool = True
) -> list[T.StructField]:
    """New columns to add; raises on a type conflict, or on new columns while
    evolution is off."""
    lines = compare(source, target)
    conflicts = [f"{c}: {s} does not fit {t}" for c, s, t, v in lines if v == "conflict"]
    if conflicts:
        raise SchemaError("incompatible column type(s): " + "; ".join(conflicts))
    new = [source[c] for c, _, _, v in lines if v == "add"]
    if new and not (evolution and add_columns):
        raise SchemaError(f"new column(s) {[f.name for f in new]} but schema evolution is off")
    return new


def add_columns_ddl(table: str, fields: list[T.StructField]) -> str:
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    return f"ALTER TABLE {table} ADD COLUMNS ({columns})"


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Reorder to the target's columns, widen types, fill missing ones with NULL."""
    out = []
    for field in target.fields:
        hit = find_column(df.columns, field.name)
        value = col(hit) if hit else F.lit(None)
        if not hit or df.schema[hit].dataType != field.dataType:
            value = value.cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)
