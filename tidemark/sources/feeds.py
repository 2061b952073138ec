"""File feeds: discovery, new-file filter, CSV scan with schema-tolerant union,
per-file counts and corrupt rows."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.columns import col, find_column
from tidemark.operators.schema import conform
from tidemark.operators.watermark import ROW_HASH
from tidemark.sinks.places import path_exists, qualified

# Columns the scans add to what the files hold; dropped before publishing.
FILE_COLUMN = "__source_file"
CORRUPT_COLUMN = "__corrupt_record"
REASON_COLUMN = "__reject_reason"
EXTRAS = (FILE_COLUMN, CORRUPT_COLUMN, REASON_COLUMN, ROW_HASH)

LISTING = "file_name string, file_path string, file_size bigint, last_modified string, file_owner string"


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """``(file_name, file_path, file_size, last_modified, file_owner)`` of the
    matching files; a missing folder has none. Contents are not read. The owner is
    unknown to Spark and not guessed; ``last_modified`` is UTC text."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LISTING)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True).load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("path").alias("file_path"),
            F.col("length").alias("file_size"),
            F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss.SSS").alias("last_modified"),
            F.lit(None).cast("string").alias("file_owner"),
        )
    )
    if recursive:
        return files
    folder = qualified(spark, path).rstrip("/")
    return files.where(F.col("file_path") == F.concat(F.lit(folder + "/"), "file_name"))


def new_files(listing: DataFrame, ledger: DataFrame, identity: Sequence[str] = ("file_path", "file_size", "last_modified")) -> DataFrame:
    """Files whose path and fingerprint (size, modification time) are not among
    those already loaded. A file rewritten in place is new again."""
    seen = ledger.select(*[col(c) for c in identity]).distinct()
    return listing.join(seen, list(identity), "left_anti")


def headers(spark: SparkSession, paths: Sequence[str], encoding: str = "utf-8") -> list[tuple[str, str]]:
    """``(path, first line)`` of every file. Each task reads one file and stops
    after the first batch of lines."""

    def first_line(batches):
        for batch in batches:
            if len(batch):
                yield batch.head(1)
                return

    # A session of our own: one file per task, and the caller's settings stay.
    reading = spark.newSession()
    reading.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 40))
    reading.conf.set("spark.sql.files.openCostInBytes", str(1 << 40))
    reading.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    text = reading.read.option("encoding", encoding).text(list(paths))
    lines = text.where(F.col("value") != "").select(F.col("_metadata.file_path").alias("path"), "value")
    found = lines.mapInPandas(first_line, "path string, value string").collect()
    return [(r["path"], r["value"].lstrip("\ufeff").rstrip("\r")) for r in found]


def csv_scan(
    spark: SparkSession,
    paths: Sequence[str],
    header: bool = True,
    delimiter: str = ",",
    encoding: str = "utf-8",
    schema: T.StructType | str | None = None,
    reasons: bool = False,
) -> DataFrame:
    """All files as one relation, united by column name; a column a file lacks is
    NULL there. Files with the same header are read together, so the number of
    scans is the number of layouts, not of files.

    Without a declared ``schema`` types are inferred per layout (an extra pass;
    a column keeps its text type wherever one layout needs it). Two columns are
    added: the file a row is from, and the raw text of rows that do not fit; with
    ``reasons`` a third says why they don't."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not paths:
        if declared is None:
            raise ValueError("no files and no declared schema")
        return spark.createDataFrame([], _with_extras(declared, reasons))
    reader = lambda: (
        spark.read.option("header", header).option("sep", delimiter).option("encoding", encoding)
    )
    layouts: dict[str, list[str]] = defaultdict(list)
    if header:
        for path, line in headers(spark, paths, encoding):
            layouts[line].append(unquote(path))
    else:
        layouts[""] = list(paths)

    parts = []
    for line, files in sorted(layouts.items()):
        if declared is None:
            part_schema = reader().option("inferSchema", True).csv(files).schema
        elif header:
            names = reader().csv(files[:1]).columns
            part_schema = T.StructType([_declared_field(declared, n) for n in names])
        else:
            part_schema = declared
        full = T.StructType([*part_schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
        part = (
            reader().schema(full).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).csv(files)
        )
        why = [reject_reason(F.col(CORRUPT_COLUMN), part_schema, delimiter).alias(REASON_COLUMN)] if reasons else []
        parts.append(part.select("*", F.col("_metadata.file_path").alias(FILE_COLUMN), *why))
    if not parts:  # every file is empty
        return spark.createDataFrame([], _with_extras(declared or T.StructType(), reasons))
    out = union_by_name(parts)
    if declared is None:
        return out
    return conform(out, _with_extras(declared, reasons))


def reject_reason(raw: Column, schema: T.StructType, delimiter: str = ",") -> Column:
    """Why a line does not fit its columns: the first value that is not of its column's
    type, or the number of its fields. NULL for a NULL line."""
    number = len(schema.fields)
    names = [f"f{k}" for k in range(number + 1)]
    cells = F.from_csv(raw, ", ".join(f"{n} STRING" for n in names), {"sep": delimiter})
    reason = F.when(cells[names[-1]].isNotNull(), F.lit(f"more than {number} field(s)"))
    for name, field in zip(names, schema.fields):
        if not isinstance(field.dataType, T.StringType):
            kind, cell = field.dataType.simpleString(), cells[name]
            misfit = cell.isNotNull() & cell.try_cast(field.dataType).isNull()
            reason = reason.when(misfit, F.concat(F.lit(f"{field.name}: "), F.substring(cell, 1, 100), F.lit(f" is no {kind}")))
    return F.when(raw.isNotNull(), reason.otherwise(F.lit(f"fewer than {number} field(s), or an open quote")))


def _declared_field(declared: T.StructType, name: str) -> T.StructField:
    hit = find_column(declared.names, name)
    return T.StructField(name, declared[hit].dataType if hit else T.StringType())


def _with_extras(schema: T.StructType, reasons: bool = False) -> T.StructType:
    names = [CORRUPT_COLUMN, FILE_COLUMN] + [REASON_COLUMN] * reasons
    return T.StructType(list(schema.fields) + [T.StructField(n, T.StringType()) for n in names])


def union_by_name(parts: Iterable[DataFrame]) -> DataFrame:
    """Union by column name, missing columns as NULL. A column whose types differ
    between the parts becomes text, whatever the order of the parts."""
    parts = list(parts)
    types = defaultdict(set)
    for part in parts:
        for f in part.schema.fields:
            types[f.name.casefold()].add(f.dataType.simpleString())
    mixed = {name for name, kinds in types.items() if len(kinds) > 1 and not _numeric_only(kinds)}
    out = None
    for part in parts:
        texts = {c: col(c).cast("string") for c in part.columns if c.casefold() in mixed}
        part = part.withColumns(texts) if texts else part
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _numeric_only(kinds: set[str]) -> bool:
    return all(k in ("int", "bigint", "double", "float", "smallint", "tinyint") or k.startswith("decimal") for k in kinds)


def without_extras(df: DataFrame) -> DataFrame:
    return df.drop(*EXTRAS)


def file_counts(df: DataFrame) -> DataFrame:
    """``(file_path, record_count, corrupt_count)`` for all files in one job. Meant
    for the stored form of a scan: two narrow columns, and nothing is parsed again."""
    corrupt = F.count_if(col(CORRUPT_COLUMN).isNotNull()) if CORRUPT_COLUMN in df.columns else F.lit(0).cast("bigint")
    return df.groupBy(col(FILE_COLUMN).alias("file_path")).agg(
        F.count(F.lit(1)).alias("record_count"), corrupt.alias("corrupt_count")
    )
