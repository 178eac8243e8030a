"""Reading topics by name, pattern, partition, offset and time, and keeping track of what was read.

All functions take a frame of records (from `TopicDataset.read`, `connector`, or any frame with record columns) and
return a frame, so selections reach the scan as filters on `topic`, `partition` and `offset`.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideway.functions import scans as S
from tideway.record import INTERNAL_TOPIC

POSITIONS = "topic string, partition int, offset bigint"


def topic_filter(source) -> Column:
    """Condition for a topic name, a list of names, or a regular expression for the whole name."""
    if isinstance(source, str):
        return F.col("topic") == source
    if isinstance(source, re.Pattern):
        return F.col("topic").rlike(f"^(?:{source.pattern})$")
    if isinstance(source, (list, tuple, set)) and source and all(isinstance(t, str) for t in source):
        return F.col("topic").isin(*source)
    raise ValueError("topics are given as a name, a non-empty list of names, or a compiled pattern")


def subscribe(df: DataFrame, source) -> DataFrame:
    return df.filter(topic_filter(source))


def add_source(df: DataFrame, source) -> DataFrame:
    """`subscribe` for hand-built graphs: a list of topics or a pattern, nothing else."""
    if isinstance(source, str) or not isinstance(source, (list, tuple, set, re.Pattern)):
        raise ValueError("a source takes a list of topics or a compiled pattern")
    return subscribe(df, source)


def assign(df: DataFrame, partitions: list[tuple[str, int]]) -> DataFrame:
    """Only the given [topic, partition] pairs; pruned as directories."""
    by_topic: dict[str, list[int]] = {}
    for topic, partition in partitions:
        by_topic.setdefault(topic, []).append(partition)
    if not by_topic:
        return df.filter(F.lit(False))
    return df.filter(reduce(lambda a, b: a | b, [
        (F.col("topic") == t) & F.col("partition").isin(*ps) for t, ps in by_topic.items()
    ]))


def positions(spark: SparkSession, offsets) -> DataFrame:
    """A position map {(topic, partition): offset}, or a frame of positions, as a frame."""
    if isinstance(offsets, DataFrame):
        return offsets.select("topic", "partition", "offset")
    return spark.createDataFrame([(t, p, o) for (t, p), o in offsets.items()], POSITIONS)


def _bounded(df: DataFrame, offsets, keep, others: bool) -> DataFrame:
    """Rows for which `keep(offset column, bound)` holds; where that is unknown, for want of a bound or an offset, they stay if `others`."""
    # one row per partition: dealt by partition instead, all records of one would meet in a task
    bounds = F.broadcast(positions(df.sparkSession, offsets).withColumnRenamed("offset", "_bound"))
    joined = df.join(bounds, ["topic", "partition"], "left" if others else "inner")
    inside = keep(F.col("offset"), F.col("_bound"))
    return joined.filter(F.coalesce(inside, F.lit(others))).select(*df.columns)


def seek(df: DataFrame, offsets) -> DataFrame:
    """Read named partitions from the given offsets on; other partitions are untouched."""
    return _bounded(df, offsets, lambda o, bound: o >= bound, others=True)


def read_slice(df: DataFrame, start, end) -> DataFrame:
    """Records with start <= offset < end, for the partitions named in both maps."""
    return _bounded(_bounded(df, start, lambda o, b: o >= b, False), end, lambda o, b: o < b, False)


def read_until(df: DataFrame, end) -> DataFrame:
    """Records with offset < end, for the partitions named in the map."""
    return _bounded(df, end, lambda o, b: o < b, False)


def beginning_offsets(df: DataFrame) -> DataFrame:
    return df.groupBy("topic", "partition").agg(F.min("offset").alias("offset"))


def end_offsets(df: DataFrame) -> DataFrame:
    """Last offset + 1 per partition."""
    return df.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))


def rewind(df: DataFrame, partitions: list[tuple[str, int]] | None = None) -> DataFrame:
    """Start positions at the first record, for the given partitions or all."""
    return beginning_offsets(assign(df, partitions) if partitions else df)


def fast_forward(df: DataFrame, partitions: list[tuple[str, int]] | None = None) -> DataFrame:
    """Start positions behind the last record, for the given partitions or all."""
    return end_offsets(assign(df, partitions) if partitions else df)


def offset_reset(df: DataFrame, policy: str) -> DataFrame:
    """Start positions for a reader without a committed one: `earliest` (usual) or `latest`."""
    if policy not in ("earliest", "latest"):
        raise ValueError(f"unknown reset policy: {policy!r}")
    return rewind(df) if policy == "earliest" else fast_forward(df)


def offsets_for_timestamps(df: DataFrame, asked: DataFrame) -> DataFrame:
    """Per asked (topic, partition, timestamp): the first offset at or after that time and its time, else nulls."""
    asked = asked.select("topic", "partition", F.col("timestamp").alias("asked"))
    found = (
        df.join(asked, ["topic", "partition"])
        .filter(F.col("timestamp") >= F.col("asked"))
        .groupBy("topic", "partition", "asked")
        .agg(F.min("offset").alias("offset"), F.min_by("timestamp", "offset").alias("timestamp"))
    )
    return asked.join(found, ["topic", "partition", "asked"], "left")


def next_offset(df: DataFrame, committed: DataFrame, policy: str = "earliest") -> DataFrame:
    """Next offset a reader would consume: the committed one, else where the reset policy starts."""
    start = offset_reset(df, policy).withColumnRenamed("offset", "_start")
    done = committed.select("topic", "partition", F.col("offset").alias("_done"))
    return start.join(done, ["topic", "partition"], "left").select(
        "topic", "partition", F.coalesce("_done", "_start").alias("offset")
    )


def lag(df: DataFrame, committed: DataFrame) -> DataFrame:
    """Records per partition that a reader has not consumed yet."""
    end = end_offsets(df).withColumnRenamed("offset", "end_offset")
    return next_offset(df, committed).join(end, ["topic", "partition"]).select(
        "topic", "partition", "offset", "end_offset", (F.col("end_offset") - F.col("offset")).alias("lag")
    )


def list_topics(df: DataFrame, internal: bool = False) -> DataFrame:
    """Topics and how many partitions they have."""
    if not internal:
        df = df.filter(~F.col("topic").rlike(INTERNAL_TOPIC))
    return df.select("topic", "partition").distinct().groupBy("topic").agg(F.count("*").alias("partitions"))


def partitions_of(df: DataFrame, topic=None) -> DataFrame:
    """Partitions of the given topics (or all): first offset, end offset, number of records."""
    df = subscribe(df, topic) if topic is not None else df
    return df.groupBy("topic", "partition").agg(
        F.min("offset").alias("beginning_offset"), (F.max("offset") + 1).alias("end_offset"),
        F.count("*").alias("records"),
    )


def read_batch(df: DataFrame, start, end=None) -> DataFrame:
    """One bounded read: everything from the start positions up to `end` (default: what is there now)."""
    return seek(df, start) if end is None else read_slice(df, start, end)


def read_batch_by_partition(df: DataFrame, worker=None, schema=None) -> DataFrame:
    """Records laid out for workers, each holding consecutive offsets of one or more partitions.

    The layout is a range partitioning by (topic, partition, offset), so a partition that holds much of the topic is cut
    into several ranges instead of going to one worker. `worker(frames)` gets an iterator of pandas frames in order.
    """
    laid = df.repartitionByRange("topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset")
    return laid if worker is None else laid.mapInArrow(worker, schema)


def extract_timestamp(df: DataFrame, f) -> DataFrame:
    """Event time from `f(previous, record)`: both give Columns, `record["value"]` etc.; previous is the raw time of
    the record before in the same partition."""
    from tideway.operators.stream import Record

    order = [c for c in ("offset", "_pos") if c in df.columns]
    probe = f(F.lit(None).cast("timestamp"), Record(df.columns))
    marked = f(F.col("_previous.timestamp"), Record(df.columns))
    if str(probe) == str(marked):  # the previous time is not used
        return df.withColumn("timestamp", probe)
    if df.isStreaming:
        from tideway.streaming.stateful import with_previous_time

        return with_previous_time(df).withColumn("timestamp", marked).select(*df.columns)
    scanned = S.scan(df, ["topic", "partition"], order, {"_previous": S.previous(F.col("timestamp").alias("timestamp"))})
    return scanned.withColumn("timestamp", marked).select(*df.columns)
