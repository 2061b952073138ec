"""Partition transforms: day, hour, month, year, bucket and identity, alone or several of them.

Parquet tables have no hidden partitioning, so a transform becomes a derived
column that the table is partitioned by. Catalogs with transforms of their own
get the native form (``native``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import col, find_column, require_columns
from tidemark.functions.zone import require_utc

_ALIASES = {
    "days": "day", "day": "day",
    "hours": "hour", "hour": "hour",
    "months": "month", "month": "month",
    "years": "year", "year": "year",
}
_FORMATS = {"hour": "yyyy-MM-dd-HH", "month": "yyyy-MM"}
_TYPES = {"day": T.DateType(), "hour": T.StringType(), "month": T.StringType(),
          "year": T.IntegerType(), "bucket": T.IntegerType()}


@dataclass(frozen=True)
class PartitionRule:
    """How a table is partitioned: ``kind`` applied to ``column``."""

    kind: str
    column: str
    buckets: int = 0

    @classmethod
    def parse(cls, kind: str | None, column: str | None) -> PartitionRule | None:
        text = (kind or "").strip().lower()
        bucket = re.fullmatch(r"bucket\s*\(\s*(\d+)\s*(?:,\s*([^)]+?)\s*)?\)", (kind or "").strip(), re.I)
        if bucket:
            column = (column or bucket.group(2) or "").strip()
            if int(bucket.group(1)) <= 0 or not column:
                raise ValueError(f"bad bucket partition {kind!r}")
            return cls("bucket", column, int(bucket.group(1)))
        if not column:
            return None
        return cls(_ALIASES.get(text, "identity"), column.strip())

    @property
    def parts(self) -> tuple[PartitionRule, ...]:
        return (self,)

    @property
    def names(self) -> list[str]:
        return [self.name]

    @property
    def is_identity(self) -> bool:
        return self.kind == "identity"

    @property
    def name(self) -> str:
        """The physical partition column."""
        return self.column if self.is_identity else f"{self.column}_{self.kind}"

    def value(self, source: Column) -> Column:
        if self.kind == "day":
            return F.to_date(source)
        if self.kind == "year":
            return F.year(source)
        if self.kind in _FORMATS:
            return F.date_format(source, _FORMATS[self.kind])
        if self.kind == "bucket":
            return F.pmod(F.hash(source), F.lit(self.buckets)).cast("int")
        return source

    def add_to(self, df: DataFrame) -> DataFrame:
        """Append the derived column (identity needs none)."""
        [source] = require_columns(df.columns, [self.column])
        if self.is_identity:
            return df
        if self.kind != "bucket" and isinstance(df.schema[source].dataType, T.TimestampType):
            require_utc(df.sparkSession)
        if find_column(df.columns, self.name):
            raise ValueError(f"column {self.name!r} is reserved for the table's partitioning")
        return df.withColumn(self.name, self.value(col(source)))

    def drop_from(self, df: DataFrame) -> DataFrame:
        return df if self.is_identity else df.drop(self.name)

    def field(self, schema: T.StructType) -> T.StructField:
        """The partition column's schema field."""
        source = schema[find_column(schema.names, self.column) or self.column]
        return T.StructField(self.name, source.dataType if self.is_identity else _TYPES[self.kind])

    def implied_by_after(self, literal: Column) -> Column | None:
        """A predicate on the partition column implied by ``column > literal``,
        so that partitions before it are pruned. NULL source values fail the
        original predicate as well, so nothing is lost."""
        if self.kind == "bucket":
            return None
        return col(self.name) >= self.value(literal)

    def native(self) -> list[Column]:
        """The transform for catalogs that support partition transforms."""
        from pyspark.sql.functions import partitioning

        if self.kind == "bucket":
            return [partitioning.bucket(self.buckets, self.column)]
        if self.is_identity:
            return [F.col(self.column)]
        return [getattr(partitioning, self.kind + "s")(self.column)]


@dataclass(frozen=True)
class PartitionRules:
    """Several rules, in their order: a table's partitions are tuples of their values."""

    parts: tuple[PartitionRule, ...]

    def __post_init__(self):
        folded = [n.casefold() for n in self.names]
        if len(set(folded)) < len(folded):
            raise ValueError(f"the partitioning names {self.names} more than once")

    @classmethod
    def parse(cls, text: str | None) -> PartitionRules | PartitionRule | None:
        """``days(sent_at), status`` and the like; a single one is a plain rule. A column
        whose name has commas or brackets needs backticks."""
        found = re.findall(r"((?:`[^`]*`|\([^()]*\)|[^,(`])+)", text or "")
        parts = []
        for piece in (t.strip() for t in found):
            if not piece:
                continue
            call = re.fullmatch(r"(\w+)\s*\((.*)\)", piece, re.S)
            if not call:
                rule = PartitionRule("identity", piece.strip("`").strip())
            elif call[1].lower() == "bucket":
                rule = PartitionRule.parse(piece, None)
            elif call[1].lower() in (*_ALIASES, "identity"):
                rule = PartitionRule.parse(call[1], call[2].strip().strip("`"))
            else:
                raise ValueError(f"unknown partition transform {call[1]!r}")
            if rule is None:
                raise ValueError(f"bad partition {piece!r}")
            parts.append(rule)
        return cls(tuple(parts)) if len(parts) > 1 else parts[0] if parts else None

    @property
    def names(self) -> list[str]:
        return [rule.name for rule in self.parts]

    def add_to(self, df: DataFrame) -> DataFrame:
        for rule in self.parts:
            df = rule.add_to(df)
        return df

    def drop_from(self, df: DataFrame) -> DataFrame:
        for rule in self.parts:
            df = rule.drop_from(df)
        return df

    def native(self) -> list[Column]:
        return [column for rule in self.parts for column in rule.native()]


#: What a table may be partitioned by.
Partitioning = PartitionRule | PartitionRules
