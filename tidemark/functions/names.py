"""Identifiers, SQL literals and unique names for DDL statements."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from tidemark.functions.columns import quoted


def identifier(*parts: str) -> str:
    return ".".join(quoted(p) for p in parts if p)


def sql_text(value) -> str:
    """A SQL string literal, or NULL."""
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def unique(prefix: str) -> str:
    """A sortable name no other run uses."""
    return f"{prefix}-{utc_now():%Y%m%d%H%M%S}-{uuid.uuid4().hex[:10]}"


def as_utc(moment: datetime) -> datetime:
    """A naive UTC time made explicit; Python and Spark would else read it in the
    machine's own zone."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
