"""Pre-load and post-load operations, run in the order the spec lists them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from tidemark.plans.spec import POSTLOAD_OPERATIONS, PRELOAD_OPERATIONS, LoadSpec, SpecError
from tidemark.sinks import maintenance
from tidemark.sinks.ledgers import WatermarkStore
from tidemark.sinks.native import NativeTable


def verify_names(spec: LoadSpec) -> None:
    """An unknown operation stops the load before any of them runs."""
    for stage, hooks, known in (
        ("preload", spec.preload, PRELOAD_OPERATIONS), ("postload", spec.postload, POSTLOAD_OPERATIONS),
    ):
        unknown = [o for o in hooks.operations if o not in known]
        if hooks.enabled and unknown:
            raise SpecError(f"unknown {stage} operation(s) {unknown}; known: {sorted(known)}")


def _run(operations: Iterable[str], actions: Mapping[str, Callable]) -> dict:
    return {name: actions[name]() for name in operations}


def preload(spec: LoadSpec, table, store: WatermarkStore, source_is_there: Callable[[], bool]) -> dict:
    """``validate_source`` checks settings and presence of the source, ``validate_target``
    says whether the table exists, ``check_watermark`` reports the last value."""
    if not spec.preload.enabled:
        return {}
    return _run(spec.preload.operations, {
        "validate_source": source_is_there,
        "validate_target": table.exists,
        "check_watermark": lambda: store.get(spec.task.id),
    })


def postload(spec: LoadSpec, table, watermark: str | None) -> dict:
    """Runs after the publish. The watermark is committed by the load itself, so
    its operation only reports the value."""
    if not spec.postload.enabled:
        return {}
    upkeep = spec.target.maintenance
    native = isinstance(table, NativeTable)

    def compact():
        if not (upkeep.enabled and upkeep.compact_small_files):
            return "off"
        if native:
            return table.compact(upkeep.target_file_size_mb, upkeep.rewrite_manifests)
        return maintenance.compact(table, upkeep.target_file_size_mb)

    def orphans():
        if not upkeep.enabled:
            return "off"
        days = upkeep.orphan_file_retention_days
        return table.remove_orphans(days) if native else maintenance.remove_orphans(table, days)

    def expire():
        if not upkeep.enabled:
            return "off"
        days = upkeep.orphan_file_retention_days
        return table.expire(days) if native else maintenance.expire_versions(table, days)

    return _run(spec.postload.operations, {
        "update_watermark": lambda: watermark,
        "refresh_metadata": table.refresh,
        "compact_table": compact,
        "compact_small_files": compact,
        "remove_orphan_files": orphans,
        "cleanup_orphan_files": orphans,
        "expire_snapshots": expire,
    })
