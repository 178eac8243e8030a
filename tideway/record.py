"""The keyed record: its columns, the order records arrive in, and time intervals.

A record is one DataFrame row with the columns below. `key` and `value` may have any Spark type and
may be null. Records that come out of a flat map also carry `_pos`, their place inside the record
they were made from, so that order stays total.
"""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADERS_TYPE = "array<struct<key:string,value:binary>>"
META = ("topic", "partition", "offset", "timestamp", "timestampType")
ORDER = ("timestamp", "topic", "partition", "offset", "_pos")

INTERNAL_TOPIC = r"-(repartition|changelog)$"  # fixed value: suffixes of topics the engine makes itself

# fixed values: nanoseconds per unit
UNIT_NS = {
    "nanoseconds": 1,
    "microseconds": 1_000,
    "milliseconds": 1_000_000,
    "seconds": 1_000_000_000,
    "minutes": 60_000_000_000,
    "hours": 3_600_000_000_000,
    "days": 86_400_000_000_000,
}


def key() -> Column:
    return F.col("key")


def value() -> Column:
    return F.col("value")


def interval_ms(interval) -> int:
    """Milliseconds in an interval: `(5, "seconds")`, `"5 seconds"`, a timedelta, or a number of ms.

    Finer units are truncated to whole milliseconds.
    """
    if isinstance(interval, bool):
        raise ValueError(f"not an interval: {interval!r}")
    if isinstance(interval, int):
        return interval
    if isinstance(interval, timedelta):
        return interval // timedelta(milliseconds=1)
    if isinstance(interval, str):
        match = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", interval.lower())
        if not match:
            raise ValueError(f"not an interval: {interval!r}")
        interval = (int(match[1]), match[2])
    number, unit = interval
    unit = unit if unit.endswith("s") else unit + "s"
    if unit not in UNIT_NS:
        raise ValueError(f"unknown unit of time: {unit!r}")
    return number * UNIT_NS[unit] // UNIT_NS["milliseconds"]


def interval_us(interval) -> int:
    return interval_ms(interval) * 1000


def interval_sql(interval) -> str:
    """The interval as the text Spark's window and watermark functions take."""
    return f"{interval_ms(interval)} milliseconds"


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def order_columns(df: DataFrame) -> list[str]:
    """Columns that put the records of a frame in their total order."""
    return [c for c in ORDER if c in df.columns]


def as_records(
    df: DataFrame,
    *,
    topic: Column | str,
    key: Column,
    value: Column,
    timestamp: Column | None = None,
    partition: Column | int = 0,
    offset: Column | None = None,
    headers: Column | None = None,
    timestamp_type: int | None = 0,
) -> DataFrame:
    """Project any DataFrame into record columns. `timestamp` may be NTZ; it is read as UTC."""
    lit = lambda c: c if isinstance(c, Column) else F.lit(c)
    return df.select(
        lit(topic).cast("string").alias("topic"),
        lit(partition).cast("int").alias("partition"),
        (offset if offset is not None else F.lit(None)).cast("bigint").alias("offset"),
        (timestamp if timestamp is not None else F.lit(None)).cast("timestamp").alias("timestamp"),
        F.lit(timestamp_type).cast("int").alias("timestampType"),
        key.alias("key"),
        value.alias("value"),
        (headers if headers is not None else F.array().cast(HEADERS_TYPE)).alias("headers"),
    )
