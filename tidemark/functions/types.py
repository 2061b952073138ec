"""Type compatibility and typed watermark literals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Lossless widening ladders; a type may widen to any later one of its ladder.
_LADDERS = (
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    (T.FloatType, T.DoubleType),
)

_WATERMARK_FAMILIES = {
    "timestamp": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "numeric": (T.NumericType,),
}

# Where an incremental load starts when nothing was loaded before.
INITIAL_WATERMARKS = {
    "timestamp": "1970-01-01 00:00:00",
    "date": "1970-01-01",
    "numeric": None,
}


def can_widen(source: T.DataType, target: T.DataType) -> bool:
    for ladder in _LADDERS:
        if type(source) in ladder and type(target) in ladder:
            return ladder.index(type(source)) < ladder.index(type(target))
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType):
        scale_grows = target.scale >= source.scale
        whole_grows = target.precision - target.scale >= source.precision - source.scale
        return source != target and scale_grows and whole_grows
    return False


def verdict(source: T.DataType, target: T.DataType | None) -> str:
    """``add`` | ``same`` | ``widen`` | ``conflict`` for one column."""
    if target is None:
        return "add"
    if source.simpleString() == target.simpleString():
        return "same"
    return "widen" if can_widen(source, target) else "conflict"


def watermark_literal(value: str, data_type: T.DataType, kind: str = "timestamp") -> Column:
    """A watermark typed like the column it is compared with, so the filter can
    be pushed to the scan. Only a timestamp may be kept as text, in a form that sorts
    like time; numbers and dates in a text column would be compared wrongly."""
    if kind not in _WATERMARK_FAMILIES:
        raise ValueError(f"unknown watermark type {kind!r}")
    if isinstance(data_type, T.StringType) and kind == "timestamp":
        return F.lit(str(value))
    if not isinstance(data_type, _WATERMARK_FAMILIES[kind]):
        raise ValueError(f"watermark type {kind!r} does not fit a {data_type.simpleString()} column")
    return F.lit(str(value)).cast(data_type)
