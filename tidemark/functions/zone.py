"""The session time zone. Partition values, audit times and watermarks are cut in UTC."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Names of the zone without offset.
_UTC = ("UTC", "ETC/UTC", "GMT", "ETC/GMT", "Z", "+00:00", "UTC+0", "GMT+0", "ZULU")


def is_utc(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.session.timeZone").strip().upper() in _UTC


def require_utc(spark: SparkSession) -> None:
    if not is_utc(spark):
        zone = spark.conf.get("spark.sql.session.timeZone")
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")
