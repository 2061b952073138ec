"""Case-insensitive column resolution and rename tracking."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F


def find_column(columns: Sequence[str], name: str) -> str | None:
    """The column spelled like ``name``, else the first that differs by case only."""
    name = name.strip()
    if name in columns:
        return name
    folded = name.casefold()
    return next((c for c in columns if c.casefold() == folded), None)


def require_columns(columns: Sequence[str], names: Iterable[str]) -> list[str]:
    """Resolve every name, raising on the ones that do not exist."""
    resolved, missing = [], []
    for name in names:
        hit = find_column(columns, name)
        (resolved if hit else missing).append(hit or name)
    if missing:
        raise ValueError(f"column(s) {missing} not found among {list(columns)}")
    return resolved


def renamed(name: str, renames: Mapping[str, str]) -> str:
    """Where a source column name ends up after the rename step."""
    hit = find_column(list(renames), name)
    return renames[hit] if hit else name


def col(name: str) -> Column:
    """A top-level column reference; dots and spaces in the name are literal."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def any_null(names: Iterable[str]) -> Column:
    """True where at least one of the columns is NULL."""
    condition = F.lit(False)
    for name in names:
        condition = condition | col(name).isNull()
    return condition


def plain_path(path: Column) -> Column:
    """A ``_metadata.file_path`` value (URI-encoded) as file listings spell it."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:///", "file:/")
