"""Topic datasets: reading and writing records as files, with transactions.

    <path>/data/part=<id>/topic=<t>/partition=<p>/*.parquet     records, sorted by offset in each file
    <path>/manifest/*.parquet                                    one row per published part
    <path>/progress/*.parquet                                    committed reader positions

A manifest row also has the ends of the part's partitions and their zones: first and last offset, least and greatest time, time of the first record.

A part is visible to committed readers once its manifest row is there; the rows of a transaction are written by one
single-file append. A part's name is its transaction's name, so a micro-batch that is replayed overwrites its own part
and is skipped when it had been published. Rewrites (compaction, pruning) publish a new generation in one row.
One writer at a time per dataset.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideway.functions import scans as S
from tideway.operators.stream import Stream
from tideway.operators.table import Table
from tideway.record import HEADERS_TYPE
from tideway.sources import positions as P

MANIFEST = """txn string, part string, state string, generation int, at bigint,
    ends array<struct<topic:string,partition:int,offset:bigint>>,
    zones array<struct<topic:string,partition:int,first:bigint,last:bigint,least:timestamp,most:timestamp,opens:timestamp>>,
    positions array<struct<group:string,topic:string,partition:int,offset:bigint>>"""
REWRITE = "rewrite-"  # begins the names of transactions that replace the content
MOST_NAMED = 1000  # parts that a query names one by one
PROGRESS = "group string, topic string, partition int, offset bigint, seq bigint"


def connector(spark: SparkSession, format: str, streaming: bool = False, schema=None, **options) -> DataFrame:
    """Records from any Spark source whose rows already have record columns (a log connector, JSON lines, …)."""
    reader = (spark.readStream if streaming else spark.read).format(format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def default_partition(df: DataFrame, n: int) -> Column:
    """Hash of the key; records without one spread by a hash of the rest, which is stable if a task is repeated."""
    rest = [F.col(c) for c in ("timestamp", "offset", "value", "_pos") if c in df.columns]
    return F.pmod(F.when(F.col("key").isNotNull(), F.xxhash64("key")).otherwise(F.xxhash64(*rest)), F.lit(n)).cast("int")


class TopicDataset:
    def __init__(self, spark: SparkSession, path: str, key_type: str = "binary", value_type: str = "binary",
                 partitions: int = 1):
        self.spark, self.path, self.partitions = spark, path.rstrip("/"), partitions
        self.schema = T.StructType.fromDDL(
            f"part string, topic string, partition int, offset bigint, timestamp timestamp, timestampType int, "
            f"key {key_type}, value {value_type}, headers {HEADERS_TYPE}"
        )

    # -- metadata ----------------------------------------------------------------------------

    def _read(self, folder: str, schema) -> DataFrame:
        """Rows of a metadata folder; none if nothing was written yet."""
        reader = self.spark.read.schema(schema).option("ignoreMissingFiles", "true")
        try:
            return reader.parquet(f"{self.path}/{folder}")
        except Exception as error:  # AnalysisException PATH_NOT_FOUND
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def manifest(self) -> DataFrame:
        return self._read("manifest", MANIFEST)

    def _generation(self) -> int:
        return self.manifest().agg(F.max("generation")).first()[0] or 0

    def published(self, txn: str) -> bool:
        return not self.manifest().filter((F.col("txn") == txn) & (F.col("state") == "committed")).isEmpty()

    # -- reading -----------------------------------------------------------------------------

    def records(self, isolation: str = "read_committed") -> DataFrame:
        """All records. Uncommitted reads also see parts that were written but not published (aborted ones never)."""
        data = self._read("data", self.schema)
        manifest = self.manifest()
        if isolation == "read_committed":
            current = (F.col("state") == "committed") & (F.col("generation") == self._generation())
            data = data.join(F.broadcast(manifest.filter(current).select("part")), "part", "left_semi")  # a row per part, which may be large
        elif isolation == "read_uncommitted":
            gone = (F.col("state") == "aborted") | (F.col("generation") < self._generation())
            data = data.join(F.broadcast(manifest.filter(gone).select("part")), "part", "left_anti")
        else:
            raise ValueError(f"unknown isolation: {isolation!r}")
        return data.drop("part")

    def read(self, source=None, *, start=None, end=None, extract_timestamp=None,
             isolation: str = "read_committed") -> DataFrame:
        """Records of the given topics (name, list, pattern; default all), from and up to given positions."""
        df = self.records(isolation)
        if source is not None:
            df = P.subscribe(df, source)
        if start is not None:
            df = P.read_batch(df, start, end)
        elif end is not None:
            df = P.read_until(df, end)
        return P.extract_timestamp(df, extract_timestamp) if extract_timestamp else df

    def stream(self, source=None, **options) -> Stream:
        return Stream(self.read(source, **options))

    def table(self, topic: str, **options) -> Table:
        """A topic as a table: a new record for a key is an update, a null value deletes it."""
        return Table(self.read(topic, **options), order=["offset"])

    def global_table(self, source, **options) -> Table:
        """The table of a small topic, for `join_global_table`. Spark broadcasts it if its size allows."""
        return self.table(source, **options)

    def global_store(self, source, processor, by=None) -> Table:
        """A table filled by a processor that is fed every record of the topic."""
        return Table(self.stream(source).process(processor, by).df)

    def start_global_store(self, source, processor, name: str, checkpoint: str, by=None, available_now: bool = True):
        """Start the query that keeps the store `name` with what the processor forwards for the records of the topic (an uncommitted read, see
        `read_stream`); returns (query, store). Every micro-batch is a version of the store; `run.join_global_store` joins streams with the
        newest one."""
        from tideway.operators.stores import Store
        from tideway.streaming.run import query_id

        updates = Stream(self.read_stream(source)).process(processor, by, time_mode="None").df
        store = Store(self.spark, name, T.StructType([updates.schema["key"], updates.schema["value"]]))

        def write(batch: DataFrame, batch_id: int):
            place = F.struct("timestamp", "topic", "partition", "offset", "_pos")
            last = batch.filter(F.col("key").isNotNull()).groupBy("key").agg(F.max_by(F.struct("value"), place).alias("_l"))
            store.upsert(last.select("key", F.col("_l.value").alias("value")), batch_id, query_id(self.spark, checkpoint))

        writer = updates.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start(), store

    def read_stream(self, source=None, *, start=None, policy: str = "earliest", max_files: int | None = None,
                    deduplicate: str | None = None, extract_timestamp=None) -> DataFrame:
        """Endless read of the records as they are written, from `start` positions or where `policy` says (`latest` =
        only what is written from now on). This is an uncommitted read: records of aborted transactions and those written again by `rewrite`
        are seen too (`stream_committed` gives published ones, once). A batch that was replayed after a crash may be seen twice;
        `deduplicate` = how far back (e.g. "1 hour") to drop records of one transaction with the same (topic, partition, offset); an
        aborted record, whose offset is given out again, does not displace the later one."""
        reader = self.spark.readStream.schema(self.schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        df = reader.parquet(f"{self.path}/data")
        if source is not None:
            df = P.subscribe(df, source)
        if start is None and policy == "latest":
            # one number per partition, fixed at the start of the query
            start = {(r["topic"], r["partition"]): r["offset"] for r in self.end_offsets().collect()}
        if start is not None:
            df = P.seek(df, start)
        if deduplicate:
            df = df.withWatermark("timestamp", deduplicate).dropDuplicatesWithinWatermark(
                ["part", "topic", "partition", "offset"])
        df = df.drop("part")
        return P.extract_timestamp(df, extract_timestamp) if extract_timestamp else df

    def stream_committed(self, sink: Callable[[DataFrame, int], None], checkpoint: str, source=None, *, max_transactions: int | None = None,
                         available_now: bool = True):
        """Start a query that calls `sink(records, batch_id)` with the records of every published transaction, once and never before it is
        published. Aborted ones do not come, and what a `rewrite` leaves does not come again: only the first batch takes the last rewritten
        content it finds in place of what that superseded. `max_transactions` limits the transactions of a batch."""
        def route(published: DataFrame, batch_id: int):
            rows = published.filter("state = 'committed' and part is not null")
            rewritten = F.col("txn").startswith(REWRITE)
            if batch_id == 0:
                newest = rows.agg(F.max("generation")).first()[0]
                rows = rows.filter(F.col("generation") == F.lit(newest))
            else:
                rows = rows.filter(~rewritten)
            df = self._read("data", self.schema).join(rows.select("part"), "part", "left_semi").drop("part")
            sink(P.subscribe(df, source) if source is not None else df, batch_id)

        reader = self.spark.readStream.schema(MANIFEST)
        if max_transactions:
            reader = reader.option("maxFilesPerTrigger", max_transactions)
        writer = reader.parquet(f"{self.path}/manifest").writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def end_offsets(self) -> DataFrame:
        """End offsets from the manifest alone, without reading records. They only grow, also where records were pruned or compacted away."""
        return (self.manifest().filter("state = 'committed'").select(F.explode("ends").alias("e")).select("e.*")
                .groupBy("topic", "partition").agg(F.max("offset").alias("offset")))

    def beginning_offsets(self) -> DataFrame:
        """First offset per partition; for one that has been emptied, its end."""
        first = P.beginning_offsets(self.records()).withColumnRenamed("offset", "_first")
        return self.end_offsets().join(first, ["topic", "partition"], "left").select(
            "topic", "partition", F.coalesce("_first", "offset").alias("offset"))

    def zones(self) -> DataFrame:
        """Per published part and partition: first and last offset, least and greatest time, and the time of the first record."""
        current = (F.col("state") == "committed") & (F.col("generation") == self._generation())
        return self.manifest().filter(current).select("part", F.explode("zones").alias("z")).select("part", "z.*")

    def offsets_for_timestamps(self, asked: DataFrame) -> DataFrame:
        """Per asked (topic, partition, timestamp): the first offset at or after that time and its time, else nulls.

        Parts whose records are all earlier are not read, nor those whose records are all later: the zone tells their first offset. Of the
        others only those are read that may begin before it.
        """
        wanted = asked.select("topic", "partition", F.col("timestamp").alias("asked")).distinct()
        place = ["topic", "partition", "asked"]
        zoned = self.zones().join(wanted, ["topic", "partition"]).filter(F.col("most") >= F.col("asked"))
        later = F.col("least") >= F.col("asked")
        known = zoned.filter(later).groupBy(*place).agg(F.min("first").alias("_known"), F.min_by("opens", "first").alias("_opens"))
        mixed = zoned.filter(~later).join(known, place, "left").filter("_known IS NULL OR first < _known").select("part", *place)
        least = wanted.agg(F.min("asked")).first()[0]
        data = self._read("data", self.schema).filter(F.col("timestamp") >= F.lit(least)).select("part", "topic", "partition", "offset", "timestamp")
        some = [r["part"] for r in mixed.select("part").distinct().limit(MOST_NAMED + 1).collect()]
        if len(some) <= MOST_NAMED:  # folders that the scan need not even list; of more, the join below takes what it needs
            data = data.filter(F.col("part").isin(some))
        read = data.join(mixed, ["part", "topic", "partition"]).filter(F.col("timestamp") >= F.col("asked"))
        read = read.groupBy(*place).agg(F.min("offset").alias("_known"), F.min_by("timestamp", "offset").alias("_opens"))
        first = known.unionByName(read).groupBy(*place).agg(F.min("_known").alias("offset"), F.min_by("_opens", "_known").alias("timestamp"))
        return asked.select("topic", "partition", F.col("timestamp").alias("asked")).join(first, place, "left")

    # -- writing -----------------------------------------------------------------------------

    def transaction(self, txn: str | None = None) -> Transaction:
        return Transaction(self, txn or uuid.uuid4().hex)

    def produce(self, df: DataFrame, **options) -> DataFrame:
        """Append records in a transaction of their own; returns topic, partition, offset, timestamp of each."""
        with self.transaction() as txn:
            return txn.produce(df, **options)

    def stream_sink(self, df: DataFrame, checkpoint: str, name: str | None = None, available_now: bool = True, mode: str = "append", **options):
        """Start a query that appends a stream, one transaction per micro-batch; replays publish nothing twice. Transactions are named
        after the query's id, which stays with its checkpoint: another query, or this one with a new checkpoint, has its own. A `name` given
        instead must be of this query and checkpoint alone."""
        def write(batch: DataFrame, batch_id: int):
            query = name or json.loads(self.spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
            # offsets take several looks at the records, each of which would run the query's state operators again
            batch.persist(StorageLevel.DISK_ONLY)
            try:
                with self.transaction(f"{query}-{batch_id}") as txn:
                    txn.produce(batch, **options)
            finally:
                batch.unpersist()

        writer = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def rewrite(self, df: DataFrame) -> None:
        """Publish `df` (records with their offsets) as the whole content of the dataset."""
        txn = self.transaction(f"{REWRITE}{uuid.uuid4().hex}")
        txn.write(df)
        txn.commit(generation=self._generation() + 1)

    # -- reader positions ---------------------------------------------------------------------

    def commit_offsets(self, group: str, offsets, seq: int | None = None) -> DataFrame:
        """Persist positions of a reader: a map, a frame of positions, or the records of a batch. Returns them."""
        if isinstance(offsets, DataFrame) and "key" in offsets.columns:
            offsets = P.end_offsets(offsets)
        rows = P.positions(self.spark, offsets).select(
            F.lit(group).alias("group"), "topic", "partition", "offset", F.lit(seq or time.time_ns()).alias("seq"))
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/progress")
        return self.consumer_group_offsets(group)

    def consumer_group_offsets(self, group: str, partitions=None) -> DataFrame:
        """Last committed positions of a group, also those committed inside transactions."""
        plain = self._read("progress", PROGRESS)
        inside = (
            self.manifest().filter("state = 'committed'")
            .select(F.explode("positions").alias("p"), F.col("at").alias("seq")).select("p.*", "seq")
        )
        last = (
            plain.unionByName(inside).filter(F.col("group") == group)
            .groupBy("topic", "partition").agg(F.max_by("offset", "seq").alias("offset"))
        )
        return P.assign(last, partitions) if partitions else last

    def committed_offset(self, group: str, topic: str, partition: int) -> int | None:
        row = self.consumer_group_offsets(group, [(topic, partition)]).first()
        return row["offset"] if row else None

    def read_uncommitted_by(self, group: str, source=None, policy: str = "earliest") -> DataFrame:
        """What a reader of this group would get next: everything from its positions on."""
        df = self.read(source)
        start = P.next_offset(df, self.consumer_group_offsets(group), policy)
        return P.seek(df, start)


class Transaction:
    """All or nothing: `produce` any number of times, `offsets` for the input read, then `commit` or `abort`.

    As a context manager it commits on success and aborts on an exception. A transaction whose name is already
    published does nothing, which makes replayed micro-batches harmless.
    """

    def __init__(self, dataset: TopicDataset, name: str):
        self.dataset, self.name = dataset, name
        self.done = dataset.published(name)
        self.parts: list[str] = []
        self.zones: list[DataFrame] = []
        self.positions: list[tuple] = []

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, error, trace):
        self.abort() if kind else self.commit()

    def produce(self, df: DataFrame, *, partitions: int | None = None, select_partition=None,
                order_by: list[str] | None = None) -> DataFrame:
        """Assign partition and offset, and write. Partition: `select_partition(topic, n, k, v)`, else the record's own,
        else a hash of its key. Offsets follow `order_by` (default: time, then the record's former place)."""
        n = partitions or self.dataset.partitions
        chosen = default_partition(df, n)
        if select_partition is not None:
            chosen = select_partition(F.col("topic"), F.lit(n), F.col("key"), F.col("value")).cast("int")
        elif "partition" in df.columns:
            chosen = F.coalesce("partition", chosen)
        columns = set(df.columns)
        formerly = [c for c in ("partition", "offset", "_pos") if c in columns]
        rows = df.select(
            "topic", chosen.alias("partition"),
            (F.col("timestamp") if "timestamp" in columns else F.lit(None)).cast("timestamp").alias("timestamp"),
            (F.col("timestampType") if "timestampType" in columns else F.lit(0)).cast("int").alias("timestampType"),
            "key", "value",
            (F.col("headers") if "headers" in columns else F.array()).cast(HEADERS_TYPE).alias("headers"),
            *[F.col(c).alias(f"_was_{c}") for c in formerly],
            *[F.col(c).alias(f"_by_{c}") for c in order_by or []],
            F.xxhash64(*[F.col(c) for c in df.columns if c not in ("headers",)]).alias("_hash"),
        )
        by = [f"_by_{c}" for c in order_by] if order_by else ["timestamp", *[f"_was_{c}" for c in formerly]]
        base = self.dataset.end_offsets()
        for zones in self.zones:
            base = base.unionByName(zones.select("topic", "partition", (F.col("last") + 1).alias("offset")))
        base = base.groupBy("topic", "partition").agg(F.max("offset").alias("_base"))
        numbered = S.scan(rows, ["topic", "partition"], [*by, "_hash"], {"_n": S.number()})
        placed = numbered.join(F.broadcast(base), ["topic", "partition"], "left").withColumn(
            "offset", F.coalesce("_base", F.lit(0)) + F.col("_n") - 1)
        return self.write(placed)

    def write(self, placed: DataFrame) -> DataFrame:
        """Write records that have their offsets already."""
        part = f"{self.name}.{len(self.parts)}"
        path = f"{self.dataset.path}/data/part={part}"
        schema = T.StructType([f for f in self.dataset.schema if f.name != "part"])
        if not self.done:
            (placed.select(*[F.col(f.name).cast(f.dataType) for f in schema])
             .sortWithinPartitions("topic", "partition", "offset")
             .write.mode("overwrite").partitionBy("topic", "partition").parquet(path))
        written = self.dataset.spark.read.schema(schema).parquet(path)
        self.parts.append(part)
        self.zones.append(written.groupBy("topic", "partition").agg(
            F.min("offset").alias("first"), F.max("offset").alias("last"), F.min("timestamp").alias("least"), F.max("timestamp").alias("most"),
            F.min_by("timestamp", "offset").alias("opens")))
        return written.select("topic", "partition", "offset", "timestamp")

    def offsets(self, group: str, offsets) -> None:
        """Positions of the reader whose records this transaction processed; published with it."""
        if isinstance(offsets, DataFrame):
            frame = P.end_offsets(offsets) if "key" in offsets.columns else offsets
            # one row per partition read
            offsets = {(r["topic"], r["partition"]): r["offset"] for r in frame.collect()}
        self.positions += [(group, t, p, o) for (t, p), o in offsets.items()]

    def commit(self, generation: int | None = None) -> None:
        if not self.done:
            self._publish("committed", self.dataset._generation() if generation is None else generation)

    def abort(self) -> None:
        if not self.done:
            self.positions = []
            self._publish("aborted", self.dataset._generation())

    def _publish(self, state: str, generation: int) -> None:
        rows = []
        for i, part in enumerate(self.parts or [None]):
            # one entry per partition written
            zones = [tuple(r) for r in self.zones[i].collect()] if part and state == "committed" else []
            ends = [(topic, partition, last + 1) for topic, partition, _, last, *_ in zones]
            rows.append((self.name, part, state, generation, time.time_ns(), ends, zones, self.positions if i == 0 else []))
        (self.dataset.spark.createDataFrame(rows, MANIFEST).coalesce(1)
         .write.mode("append").parquet(f"{self.dataset.path}/manifest"))
        self.done = True
