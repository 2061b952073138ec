"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.columns import col, require_columns


def latest(df: DataFrame, keys: Iterable[str], newest_by: Sequence[str]) -> DataFrame:
    """The newest row of every key; NULL keys count as one key.

    Filtering ``row_number() = 1`` lets Spark cut every key to one row per task
    before the shuffle (WindowGroupLimit), so a hot key costs no more than others.
    Ties beyond ``newest_by`` are broken by the row's hash, so reruns agree."""
    names = require_columns(df.columns, keys)
    order = [col(c).desc_nulls_last() for c in require_columns(df.columns, newest_by)]
    order.append(F.xxhash64(*[col(c) for c in df.columns]).desc())
    ranked = Window.partitionBy(*[col(k) for k in names]).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")
