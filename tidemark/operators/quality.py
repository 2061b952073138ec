"""Quality rules: minimum rows, nulls, uniqueness; report, violating rows, gate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import any_null, col, renamed, require_columns


class QualityError(Exception):
    """A rule is violated; nothing was published."""


@dataclass(frozen=True)
class QualityRules:
    """``check_null_keys`` / ``check_duplicate_keys`` say whether the merge keys
    are checked where no explicit list is given; None means: when merging."""

    enabled: bool = True
    null_check: tuple[str, ...] = ()
    unique_check: tuple[str, ...] = ()
    minimum_rows: int = 0
    check_null_keys: bool | None = None
    check_duplicate_keys: bool | None = None

    def effective(
        self,
        columns: Sequence[str],
        merge_keys: Iterable[str] | None = None,
        renames: Mapping[str, str] | None = None,
    ) -> QualityRules:
        """The same rules with fallbacks applied and names resolved; a name may
        be the one before the rename."""
        keys = tuple(merge_keys or ())
        null_keys = keys if self.check_null_keys in (None, True) else ()
        unique_keys = keys if self.check_duplicate_keys in (None, True) else ()

        def names(listed: tuple[str, ...]) -> tuple[str, ...]:
            return tuple(require_columns(columns, [renamed(n, renames or {}) for n in listed]))

        return QualityRules(
            self.enabled,
            names(self.null_check or null_keys),
            names(self.unique_check or unique_keys),
            self.minimum_rows,
            False,
            False,
        )


@dataclass(frozen=True)
class QualityResult:
    passed: bool
    total_rows: int = 0
    processed_rows: int = 0
    null_key_count: int = 0
    duplicate_key_count: int = 0
    error_message: str | None = None


def row_count(df: DataFrame, minimum: int = 0) -> DataFrame:
    """One row ``(rule, total_rows, passed)``."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        F.lit("minimum_rows").alias("rule"),
        "total_rows",
        (F.col("total_rows") >= F.lit(minimum)).alias("passed"),
    )


def null_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows in which any of the columns is NULL."""
    return df.where(any_null(require_columns(df.columns, columns)))


def null_count(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return null_rows(df, columns).agg(F.count(F.lit(1)).alias("violations"))


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Key groups that occur more than once, with their size. NULL keys form a
    group. The count combines before the shuffle, so a hot key is one row per task."""
    names = require_columns(df.columns, keys)
    return df.groupBy(*[col(k) for k in names]).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def duplicate_count(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("dup_groups"))


def duplicate_rows(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Every row of every duplicated key group.

    A semi join against the aggregated keys, not a window: a window would put a
    whole key group into one task, whereas a hot key on the left of a semi join
    is split by adaptive skew handling (or not shuffled, if the keys are few)."""
    names = require_columns(df.columns, keys)
    groups = duplicate_keys(df, names).select(*[col(k).alias(f"__dup_{i}") for i, k in enumerate(names)])
    condition = F.lit(True)
    for i, k in enumerate(names):
        condition = condition & col(k).eqNullSafe(F.col(f"__dup_{i}"))
    return df.join(groups, condition, "left_semi")


def measure(df: DataFrame, rules: QualityRules) -> DataFrame:
    """One row ``(total_rows, null_rows, duplicate_groups)`` from a single scan.

    With a uniqueness rule the counts are taken per key first and then summed,
    which costs the one shuffle uniqueness needs anyway."""
    rows = F.count(F.lit(1))
    nulls = F.count_if(any_null(rules.null_check))
    if not rules.unique_check:
        return df.agg(rows.alias("total_rows"), nulls.alias("null_rows"), F.lit(0).cast("bigint").alias("duplicate_groups"))
    per_key = df.groupBy(*[col(k) for k in rules.unique_check]).agg(rows.alias("__n"), nulls.alias("__nulls"))
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("__n"), zero).alias("total_rows"),
        F.coalesce(F.sum("__nulls"), zero).alias("null_rows"),
        F.count_if(F.col("__n") > 1).alias("duplicate_groups"),
    )


def report(df: DataFrame, rules: QualityRules, merge_keys: Iterable[str] | None = None) -> DataFrame:
    """One row per active rule: ``(rule, violations, passed)``. For minimum_rows
    the number is the row count itself."""
    rules = rules.effective(df.columns, merge_keys)
    lines = [("minimum_rows", F.col("total_rows"), F.col("total_rows") >= F.lit(rules.minimum_rows))]
    if rules.null_check:
        lines.append(("null_check", F.col("null_rows"), F.col("null_rows") == 0))
    if rules.unique_check:
        lines.append(("unique_check", F.col("duplicate_groups"), F.col("duplicate_groups") == 0))
    structs = [
        F.struct(F.lit(name).alias("rule"), number.alias("violations"), passed.alias("passed"))
        for name, number, passed in lines
    ]
    return measure(df, rules).select(F.inline(F.array(*structs)))


def judge(rules: QualityRules, total_rows: int, null_rows: int = 0, duplicate_groups: int = 0) -> QualityResult:
    """Verdict over measured numbers, first violated rule first. Minimum rows is
    checked before an empty batch is let through."""
    if not rules.enabled:
        return QualityResult(True)
    problem = None
    if rules.minimum_rows > 0 and total_rows < rules.minimum_rows:
        problem = f"minimum_rows: {total_rows} row(s), at least {rules.minimum_rows} required"
    elif total_rows and null_rows:
        problem = f"null_check: {null_rows} row(s) with NULL in {list(rules.null_check)}"
    elif total_rows and duplicate_groups:
        problem = f"unique_check: {duplicate_groups} duplicated key group(s) on {list(rules.unique_check)}"
    return QualityResult(problem is None, total_rows, 0 if problem else total_rows, null_rows, duplicate_groups, problem)


def enforce(result: QualityResult) -> QualityResult:
    if not result.passed:
        raise QualityError(result.error_message)
    return result


def check(df: DataFrame | None, rules: QualityRules, merge_keys: Iterable[str] | None = None) -> QualityResult:
    """Run the rules as one job; raises QualityError on the first violated rule."""
    if df is None or not rules.enabled:
        return QualityResult(True)
    rules = rules.effective(df.columns, merge_keys)
    return enforce(judge(rules, *measure(df, rules).first()))


def sample(violations: DataFrame, rows: int = 50) -> DataFrame:
    """A few violating rows for a report, the same ones each time: those with the smallest
    hashes of their JSON form. The limit is the point of it."""
    shown = violations.select(F.to_json(F.struct(*[col(c) for c in violations.columns])).alias("row"))
    return shown.orderBy(F.xxhash64("row"), "row").limit(rows)


def violations(df: DataFrame, rules: QualityRules, result: QualityResult, rows: int = 50) -> DataFrame | None:
    """``(rule, row)`` for the rules that a batch has failed: up to ``rows`` rows of each. Minimum
    rows has none to show."""
    parts = []
    if result.null_key_count:
        parts.append(("null_check", null_rows(df, rules.null_check)))
    if result.duplicate_key_count:
        parts.append(("unique_check", duplicate_rows(df, rules.unique_check)))
    out = None
    for name, found in parts:
        part = sample(found, rows).select(F.lit(name).alias("rule"), "row")
        out = part if out is None else out.unionByName(part)
    return out
