"""Streams of keyed records.

Functions given to these methods are called once, with Columns for key and value, and return Columns, so that
filters are pushed into the scan and projections stay inside generated code. Every method works on batch and
streaming DataFrames unless it says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideway.operators import joins
from tideway.operators.grouped import GroupedStream


class Stream:
    def __init__(self, df: DataFrame):
        self.df = df

    # -- one record at a time ---------------------------------------------------------------

    def filter_kv(self, pred) -> Stream:
        """Keep records where `pred(k, v)` is true; null counts as false."""
        return Stream(self.df.filter(pred(F.col("key"), F.col("value"))))

    def map_kv(self, f) -> Stream:
        """`f(k, v)` returns the pair (new key, new value)."""
        k, v = f(F.col("key"), F.col("value"))
        return Stream(self.df.withColumns({"key": k, "value": v}))

    def map_keys(self, f) -> Stream:
        return Stream(self.df.withColumn("key", f(F.col("key"), F.col("value"))))

    def map_values(self, f) -> Stream:
        """New value, same key: an existing partitioning by key stays usable."""
        return Stream(self.df.withColumn("value", f(F.col("key"), F.col("value"))))

    def _exploded(self, items: Column) -> tuple[DataFrame, list[str]]:
        meta = [c for c in self.df.columns if c not in ("key", "value", "_pos")]
        old = F.col("_pos") if "_pos" in self.df.columns else F.array().cast("array<bigint>")
        df = self.df.select(*meta, "key", old.alias("_old"), F.posexplode(items).alias("_at", "_item"))
        return df.withColumn("_pos", F.concat("_old", F.array(F.col("_at").cast("bigint")))), meta

    def fmap_kv(self, f) -> Stream:
        """`f(k, v)` returns an array of (key, value) structs, or a map; one record per entry, none for null."""
        items = f(F.col("key"), F.col("value"))
        kind = self.df.select(items).schema[0].dataType
        if isinstance(kind, T.MapType):
            first, second = "key", "value"
            items = F.map_entries(items)
        else:
            first, second = kind.elementType.fieldNames()[:2]
        df, meta = self._exploded(items)
        df = df.filter(F.col("_item").isNotNull())
        return Stream(df.select(*meta, F.col("_item")[first].alias("key"), F.col("_item")[second].alias("value"), "_pos"))

    def fmap_values(self, f) -> Stream:
        """`f(k, v)` returns an array of values; one record per item, none for null or empty."""
        df, meta = self._exploded(f(F.col("key"), F.col("value")))
        return Stream(df.select(*meta, "key", F.col("_item").alias("value"), "_pos"))

    def branch(self, predicates: list) -> list[Stream]:
        """One stream per predicate; a record goes to the first that holds, or nowhere.

        Each branch is a plain filter, so it can be pushed to the scan on its own. To split a stream in one pass over
        its input, use `tag_branch` and route on the tag.
        """
        k, v = F.col("key"), F.col("value")
        held = [F.coalesce(p(k, v), F.lit(False)) for p in predicates]
        out = []
        for i, here in enumerate(held):
            for earlier in held[:i]:
                here = here & ~earlier
            out.append(Stream(self.df.filter(here)))
        return out

    def tag_branch(self, predicates: list, column: str = "branch") -> DataFrame:
        """The same split as one frame with the number of the branch; records that match nothing are gone."""
        k, v = F.col("key"), F.col("value")
        tag = F.coalesce(*[F.when(p(k, v), F.lit(i)) for i, p in enumerate(predicates)])
        return self.df.withColumn(column, tag).filter(F.col(column).isNotNull())

    def merge_stream(self, other: Stream) -> Stream:
        """All records of both; nothing is said about order between them."""
        return Stream(self.df.unionByName(other.df, allowMissingColumns=True))

    # -- joins ------------------------------------------------------------------------------

    def join_stream(self, other: Stream, f, interval, **options) -> Stream:
        return Stream(joins.stream_stream(self.df, other.df, f, interval, "inner", **options))

    def left_join_stream(self, other: Stream, f, interval, **options) -> Stream:
        return Stream(joins.stream_stream(self.df, other.df, f, interval, "left", **options))

    def outer_join_stream(self, other: Stream, f, interval, **options) -> Stream:
        return Stream(joins.stream_stream(self.df, other.df, f, interval, "outer", **options))

    def join_table(self, table, f, retention=None) -> Stream:
        return Stream(joins.stream_table(self.df, table, f, "inner", retention))

    def left_join_table(self, table, f, retention=None) -> Stream:
        return Stream(joins.stream_table(self.df, table, f, "left", retention))

    def join_global_table(self, table, f_key, f) -> Stream:
        return Stream(joins.stream_global(self.df, table, f_key, f, "inner"))

    def left_join_global_table(self, table, f_key, f) -> Stream:
        return Stream(joins.stream_global(self.df, table, f_key, f, "left"))

    # -- grouping ---------------------------------------------------------------------------

    def group_by(self, f) -> GroupedStream:
        """Group by `f(k, v)`; records with a null group key are dropped."""
        return GroupedStream(self.df.withColumn("key", f(F.col("key"), F.col("value"))))

    def group_by_key(self) -> GroupedStream:
        return GroupedStream(self.df)

    # -- processors and side effects ----------------------------------------------------------

    def process(self, processor, by=None, **streaming) -> Stream:
        """Output is whatever the processor forwards. `by(k, v)` chooses what state is kept per (default: the key). For a stream there are
        `time_mode` and `retention`, see `tideway.streaming.stateful.process_stream`."""
        from tideway.operators.processors import process

        return Stream(process(self.df, processor, by, **streaming))

    def process_values(self, processor) -> Stream:
        """Values replaced by what the processor returns; forwarding is an error."""
        from tideway.operators.processors import process_values

        return Stream(process_values(self.df, processor))

    def do_kv(self, f: Callable[[object, object], None]) -> Stream:
        """Call the Python function `f(key, value)` per record and pass the records on. May repeat on retries."""
        def each(batches):
            for batch in batches:
                for k, v in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist()):
                    f(k, v)
                yield batch

        return Stream(self.df.mapInArrow(each, self.df.schema))

    def observe(self, name, *aggregates: Column) -> Stream:
        """Side effect without Python per record: named aggregates reported by Spark's `observe`."""
        return Stream(self.df.observe(name, *aggregates))

    def sink_do(self, f: Callable[[object, object], None], checkpoint: str | None = None):
        """Terminal `do_kv`. On a stream it starts and returns the query."""
        def row(r):
            f(r["key"], r["value"])

        if self.df.isStreaming:
            return self.df.writeStream.foreach(row).option("checkpointLocation", checkpoint).start()
        self.df.select("key", "value").foreach(row)

    def sink_process(self, processor, by=None, checkpoint: str | None = None):
        """Terminal processor: it runs for its effects and its output goes nowhere."""
        out = self.process(processor, by).df
        if out.isStreaming:
            return (out.writeStream.format("noop").outputMode("update")
                    .option("checkpointLocation", checkpoint).start())
        out.write.format("noop").mode("overwrite").save()

    # -- topics -----------------------------------------------------------------------------

    def sink_topic(self, dataset, topic, **options):
        """Send to one topic (a name) or to the topic `f(record)` picks per record (`record["value"]` and so on)."""
        df = with_topic(self.df, topic)
        if df.isStreaming:
            return dataset.stream_sink(df, **options)
        return dataset.produce(df, **options)

    def sink_children(self, dataset, topics: dict[str, str], **options):
        """Send what a processor forwarded on: records for a child to the topic of that child, records for no child in particular to all of them.
        All topics are written in one pass and one transaction (on a stream, one per micro-batch). A child without a topic is an error."""
        child = F.col("child")
        named = F.coalesce(*[F.when(child == c, F.array(F.lit(t))) for c, t in topics.items()],
                           F.raise_error(F.concat(F.lit("no topic for the child "), child)).cast("array<string>"))
        everywhere = F.array(*[F.lit(t) for t in dict.fromkeys(topics.values())])
        # places are those of the record that was processed; in the new topics they follow from the keys
        routed = self.df.withColumn("topic", F.explode(F.when(child.isNull(), everywhere).otherwise(named))).drop("child", "partition")
        return dataset.stream_sink(routed, **options) if routed.isStreaming else dataset.produce(routed, **options)

    def through_topic(self, dataset, topic: str, **options) -> Stream:
        """Write to a topic and go on from what was written. On a stream the writing query runs until its input ends."""
        written = self.sink_topic(dataset, topic, **options)
        if self.df.isStreaming:
            written.awaitTermination()
            return Stream(dataset.read_stream(topic))
        return Stream(dataset.read(topic))


def add_sink(parents: list[Stream], dataset, topic, **options):
    """Send the records of several streams (or processors) to one topic, in one transaction; `topic` as for `sink_topic`."""
    merged = parents[0]
    for other in parents[1:]:
        merged = merged.merge_stream(other)
    return merged.sink_topic(dataset, topic, **options)


def add_processor(parents: list[Stream], processor, by=None) -> Stream:
    """A processor fed by several streams, each key's records in their total order."""
    merged = parents[0]
    for other in parents[1:]:
        merged = merged.merge_stream(other)
    return merged.process(processor, by)


class Record:
    """A record as topic and partition choosers see it: `record["value"]` is a Column, unknown fields are null."""

    def __init__(self, columns):
        self.columns = columns

    def __getitem__(self, name: str) -> Column:
        return F.col(name) if name in self.columns else F.lit(None)


def with_topic(df: DataFrame, topic) -> DataFrame:
    chosen = topic(Record(df.columns)) if callable(topic) else F.lit(topic)
    return df.withColumn("topic", chosen.cast("string"))
