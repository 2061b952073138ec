"""Splits of a scan with about equally many rows each, as disjoint SQL conditions.

A range of values cut into equal widths gives one query most of the rows when values
are skewed. Here the cuts are quantiles, so they follow the rows; a value with more rows
than a split should have gets a split of its own, or several by a second column; rows
without a value get one too. Every row meets exactly one condition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import col, require_columns

#: Quantiles that are asked for each split, to see which values repeat.
_FINE = 4
#: Relative precision of quantiles is one by this.
_ACCURACY = 100_000


@dataclass(frozen=True)
class Split:
    """A condition on the split columns, as SQL and as a column, and about how many rows it has."""

    sql: str
    condition: Column
    rows: int


def _literal(value, typed: bool) -> str:
    """A value as databases spell it; ``typed`` ones name the type of dates and times."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if value.microsecond else value.strftime("%Y-%m-%d %H:%M:%S")
        return f"TIMESTAMP '{text}'" if typed else f"'{text}'"
    if isinstance(value, dt.date):
        return f"DATE '{value}'" if typed else f"'{value}'"
    return "'" + str(value).replace("'", "''") + "'"


def ordered(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _quantiles(rows: DataFrame, name: str, number: int) -> list:
    """Up to ``number - 1`` cuts of the rows by a column, NULLs aside; repeated ones stay.
    One row comes back, however many rows there are."""
    if number < 2:
        return []
    steps = [k / number for k in range(1, number)]
    if ordered(rows.schema[name].dataType):
        found = rows.agg(F.percentile_approx(col(name), steps, _ACCURACY)).first()[0]
        return [v for v in found or [] if v == v]  # NaN is no cut
    # texts have no approximate quantiles: those of a sample of distinct ones, weighted by their rows
    counts = rows.where(col(name).isNotNull()).groupBy(col(name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    largest = counts.orderBy(F.desc("n"), "v").limit(_FINE * number).collect()
    spread = counts.orderBy(F.xxhash64("v"), "v").limit(_ACCURACY // 10).collect()
    weights = {r["v"]: r["n"] for r in (*spread, *largest)}
    total, seen, cuts, want = sum(weights.values()), 0, [], list(steps)
    for value in sorted(weights):
        seen += weights[value]
        while want and seen >= want[0] * total:
            cuts.append(value)
            want.pop(0)
    return cuts


def equal_splits(df: DataFrame, columns: str | Sequence[str], splits: int, typed_literals: bool = True) -> list[Split]:
    """Conditions that split ``df`` into about ``splits`` parts of equally many rows.

    The first of ``columns`` is cut by its quantiles. A value with more rows than a part
    is a part of its own; with a second column such a value's rows are cut by that one,
    and so on. NULL is a part if it has rows. Only the split columns are read: one pass for
    the quantiles, one that counts the values that repeat among them, and another one for the
    quantiles of the rest if there are such values.

    Texts are compared by their bytes; where a database compares them otherwise, use numbers,
    dates or times.
    """
    if splits < 1:
        raise ValueError("at least one split")
    names = require_columns(df.columns, [columns] if isinstance(columns, str) else list(columns))
    if not names:
        raise ValueError("a split needs a column")
    rows = df.select(*[col(n) for n in dict.fromkeys(names)])
    return _split(rows, names, splits, typed_literals)


def _split(rows: DataFrame, names: list[str], splits: int, typed: bool) -> list[Split]:
    name, rest = names[0], names[1:]
    column, quoted, spell = col(name), name, lambda v: _literal(v, typed)
    fine = _quantiles(rows, name, _FINE * splits)
    repeated = sorted({a for a, b in zip(fine, fine[1:]) if a == b})
    counted = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(column.isNull()).alias("empty"),
        *[F.count_if(column == F.lit(v)).alias(f"v{k}") for k, v in enumerate(repeated)]).first()
    total, mean = counted["rows"], counted["rows"] / splits
    heavy = {v: counted[f"v{k}"] for k, v in enumerate(repeated) if counted[f"v{k}"] > mean}
    out = []
    others = rows.where(column.isNotNull() & ~column.isin(list(heavy))) if heavy else rows.where(column.isNotNull())
    left = total - counted["empty"] - sum(heavy.values())
    number = max(1, round(left / mean)) if mean else 1
    cuts = sorted(set(_quantiles(others, name, number) if heavy or counted["empty"] else fine[_FINE - 1::_FINE]))
    light = f" AND {quoted} NOT IN ({', '.join(map(spell, sorted(heavy)))})" if heavy else ""
    is_light = ~column.isin(list(heavy)) if heavy else F.lit(True)
    for low, high in zip([None, *cuts], [*cuts, None]):
        sides = [f"{quoted} > {spell(low)}"] * (low is not None) + [f"{quoted} <= {spell(high)}"] * (high is not None)
        inside = F.lit(True)
        if low is not None:
            inside = inside & (column > F.lit(low))
        if high is not None:
            inside = inside & (column <= F.lit(high))
        text = " AND ".join(sides) or f"{quoted} IS NOT NULL"
        out.append(Split(f"{text}{light}", column.isNotNull() & inside & is_light, left // (len(cuts) + 1)))
    for value, n in sorted(heavy.items()):
        here = Split(f"{quoted} = {spell(value)}", F.coalesce(column == F.lit(value), F.lit(False)), n)
        out += _within(rows, here, rest, n, mean, typed)
    if counted["empty"]:
        here = Split(f"{quoted} IS NULL", column.isNull(), counted["empty"])
        out += _within(rows, here, rest, counted["empty"], mean, typed)
    return out


def _within(rows: DataFrame, here: Split, names: list[str], n: int, mean: float, typed: bool) -> list[Split]:
    """The rows of one value, cut by the next column if they are too many for a split."""
    parts = round(n / mean) if mean else 1
    if not names or parts < 2:
        return [here]
    inner = _split(rows.where(here.condition), names, parts, typed)
    return [Split(f"{here.sql} AND {s.sql}", here.condition & s.condition, s.rows) for s in inner]
