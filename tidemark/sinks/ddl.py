"""CREATE TABLE statements and the fixed schemas of governance and bronze tables."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import types as T

from tidemark.functions.columns import quoted
from tidemark.functions.names import sql_text
from tidemark.functions.partitioning import Partitioning, PartitionRule, PartitionRules

_AUDIT = "dwh_insert_ts TIMESTAMP, dwh_updated_ts TIMESTAMP, dwh_etl_run_id STRING, dwh_job_user STRING"

# Columns and partitioning of the bronze tables.
BRONZE = {
    "customer": (
        "customer_id BIGINT, customer_name STRING, status STRING, balance DECIMAL(18,2), "
        f"updated_at TIMESTAMP, {_AUDIT}", "days", "updated_at"),
    "sqlserver_invoices": (
        "invoice_id BIGINT, customer_id BIGINT, total_amount DECIMAL(18,2), status STRING, "
        f"created_at TIMESTAMP, {_AUDIT}", "days", "created_at"),
    "mysql_orders": (
        "order_id BIGINT, customer_id BIGINT, order_amount DECIMAL(18,2), status STRING, "
        f"created_at TIMESTAMP, {_AUDIT}", "days", "created_at"),
    "postgres_payments": (
        "payment_id BIGINT, account_id BIGINT, amount DECIMAL(18,2), payment_method STRING, "
        f"created_at TIMESTAMP, {_AUDIT}", "days", "created_at"),
    "sftp_invoices_csv": (
        f"invoice_id STRING, customer_id STRING, total_amount DECIMAL(18,2), status STRING, {_AUDIT}",
        "days", "dwh_insert_ts"),
    "sftp_settlements_excel": (
        f"settle_id STRING, card_no STRING, amount DECIMAL(18,2), {_AUDIT}", "days", "dwh_insert_ts"),
}

# Columns of the governance ledgers.
FILE_AUDIT = (
    "file_name STRING, file_path STRING, file_size_bytes BIGINT, last_modified_ts STRING, file_owner STRING, "
    "target_table STRING, load_timestamp STRING, record_count BIGINT, status STRING, error_message STRING"
)
WATERMARKS = "job_id STRING, watermark_value STRING, updated_at TIMESTAMP"
# Rows that a job's last batch had at its watermark.
BOUNDARIES = (
    "job_id STRING, watermark_value STRING, updated_at TIMESTAMP, source_columns ARRAY<STRING>, "
    "row_hash STRUCT<one: BIGINT, two: BIGINT>, copies BIGINT"
)
RUNS = (
    "run_id STRING, job_id STRING, source_type STRING, target_table STRING, start_time TIMESTAMP, "
    "end_time TIMESTAMP, duration_seconds DOUBLE, rows_read BIGINT, rows_written BIGINT, status STRING, "
    "error_message STRING"
)
# Beyond the telemetry columns: what the per-run success and failure records hold.
RUN_DETAILS = "job_name STRING, load_type STRING, config_path STRING, error_type STRING, error_trace STRING"
# Rows for which a batch was refused.
QUALITY_SAMPLES = "job_id STRING, run_id STRING, rule STRING, row STRING, recorded_at TIMESTAMP"
# What a file looked like when it was loaded last, by target.
FILE_STATE = "target_table STRING, file_path STRING, file_size BIGINT, last_modified STRING, until DATE"
# Signs of life of runs: that they have started, go on, have ended.
SIGNALS = "job_id STRING, run_id STRING, signal STRING, at TIMESTAMP, step STRING"
# Rows of feeds that did not fit their file's columns.
REJECTED = "file_path STRING, raw_text STRING, reason STRING, run_id STRING, rejected_at TIMESTAMP"
NOTIFICATIONS = (
    "notification_id STRING, job_id STRING, job_name STRING, run_id STRING, event_type STRING, "
    "pipeline_status STRING, sender STRING, recipients_to STRING, recipients_cc STRING, subject STRING, "
    "template_used STRING, email_status STRING, error_message STRING, sent_timestamp TIMESTAMP"
)

# Partitioning of the governance tables, for catalogs with transforms and for
# copies of the ledgers; a ledger itself is partitioned by scope and commit.
GOVERNANCE = {
    "watermark_store": (WATERMARKS, "job_id"),
    "sftp_file_audit": (FILE_AUDIT, "target_table"),
    "etl_pipeline_telemetry": (RUNS, "days(start_time)"),
    "etl_email_audit": (NOTIFICATIONS, "days(sent_timestamp), email_status"),
}

PARTITION_PROPERTY = "tidemark.partition"


def columns_sql(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def create_table(
    name: str,
    schema: T.StructType,
    location: str,
    partition_columns: Iterable[str] = (),
    properties: Mapping[str, str] | None = None,
) -> str:
    """An external parquet table, zstd-compressed."""
    parts = list(partition_columns)
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({columns_sql(schema)}) USING parquet"
    statement += " OPTIONS ('compression' = 'zstd')"
    if parts:
        statement += f" PARTITIONED BY ({', '.join(quoted(p) for p in parts)})"
    statement += f" LOCATION {sql_text(location)}"
    if properties:
        pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in properties.items())
        statement += f" TBLPROPERTIES ({pairs})"
    return statement


def rule_text(rule: Partitioning) -> str:
    """One rule as ``kind:buckets:column``, several as a JSON list of such texts."""
    texts = [f"{r.kind}:{r.buckets}:{r.column}" for r in rule.parts]
    return texts[0] if len(texts) == 1 else json.dumps(texts)


def rule_from_text(text: str) -> Partitioning:
    texts = json.loads(text) if text.startswith("[") else [text]
    rules = []
    for kind, buckets, column in (t.split(":", 2) for t in texts):
        rules.append(PartitionRule(kind, column, int(buckets)))
    return rules[0] if len(rules) == 1 else PartitionRules(tuple(rules))
