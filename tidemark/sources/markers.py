"""Run marker files: text files of ``KEY : value`` lines, one file per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The keys of a marker file, and the column each one becomes.
MARKER_KEYS = {
    "JOB ID": "job_id",
    "CONFIG PATH": "config_path",
    "EXECUTION RUN ID": "run_id",
    "STATUS": "status",
    "ROWS READ": "rows_read",
    "ROWS WRITTEN": "rows_written",
    "DURATION (SECONDS)": "duration_seconds",
    "ERROR TYPE": "error_type",
    "ERROR MESSAGE": "error_message",
}
_TYPES = {"rows_read": "bigint", "rows_written": "bigint", "duration_seconds": "double"}


def _value(key: str) -> Column:
    escaped = key.replace("(", r"\(").replace(")", r"\)")
    found = F.regexp_extract("value", rf"(?m)^{escaped}[ \t]*:[ \t]*(.*?)[ \t\r]*$", 1)
    return F.nullif(found, F.lit(""))


def scan(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """One row per marker file below ``path``: its path, the time of the record
    and its keys. A file with an error but no status line is a failed run."""
    text = (
        spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
        .select("value", F.col("_metadata.file_path").alias("marker"))
    )
    columns = {
        name: _value(key).try_cast(_TYPES[name]) if name in _TYPES else _value(key)
        for key, name in MARKER_KEYS.items()
    }
    stamp = F.regexp_extract("value", r"(?m)^(?:FAILURE|SUCCESS) RECORD TIMESTAMP[ \t]*:[ \t]*(\S+)", 1)
    inferred = F.when(F.col("value").startswith("FAILURE"), F.lit("FAILED"))
    columns["status"] = F.coalesce(columns["status"], inferred)
    return text.select(
        "marker",
        stamp.try_cast("timestamp").alias("recorded_at"),
        *[value.alias(name) for name, value in columns.items()],
    )
