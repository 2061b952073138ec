"""Declarative ingestion and table maintenance on PySpark."""

from tidemark.plans.load import LoadResult, dry_run, open_target, run_load
from tidemark.plans.spec import LoadSpec, SpecError

__all__ = ["LoadResult", "LoadSpec", "SpecError", "dry_run", "open_target", "run_load"]
