"""Running streaming frames to files and stores below the shared folder."""

from __future__ import annotations

import json
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideway.operators.stores import Store
from tideway.session import fresh_path


def kept(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def start_to_files(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Start a query that writes every emitted row, one folder per micro-batch (a replay overwrites its own folder)."""
    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_to_files(df: DataFrame, mode: str = "append", path: str | None = None) -> DataFrame:
    """Process what is there now and return the emitted rows, with `batch`, the number of the micro-batch."""
    spark = df.sparkSession
    path = path or fresh_path(spark, "stream")
    start_to_files(df, path, f"{path}-checkpoint", mode).awaitTermination()
    schema = T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def run_until_idle(df: DataFrame, mode: str = "append", path: str | None = None, most_seconds: float = 600) -> DataFrame:
    """The same for queries in processing time, which never end by themselves, as they wait for their timers: stopped once a micro-batch has found
    nothing more to read, or if none ends for `most_seconds`."""
    spark = df.sparkSession
    path = path or fresh_path(spark, "stream")

    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}-checkpoint").start()
    try:
        until, before = time.monotonic() + most_seconds, None
        while query.isActive and not ((last := query.lastProgress) and last["batchId"] and not last["numInputRows"]):
            if last and last["batchId"] != before:
                until, before = time.monotonic() + most_seconds, last["batchId"]
            if time.monotonic() > until:
                raise TimeoutError(f"no micro-batch has ended for {most_seconds} s")
            time.sleep(0.2)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()
    schema = T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def run_to_store(df: DataFrame, name: str, mode: str = "update", checkpoint: str | None = None) -> Store:
    """Keep the store `name` up to date with a streaming table (columns key, [window_from, window_to,] value)."""
    spark = df.sparkSession
    checkpoint = checkpoint or fresh_path(spark, "checkpoint")
    query, store = start_to_store(df, name, checkpoint, mode)
    query.awaitTermination()
    return store


def query_id(spark, checkpoint: str) -> str:
    """Id of the query with this checkpoint; it stays the same over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_to_store(df: DataFrame, name: str, checkpoint: str, mode: str = "update", available_now: bool = True):
    """Start the query that keeps the store `name`; returns (query, store). Several queries and puts by hand can feed one store."""
    spark = df.sparkSession
    store = Store(spark, name, df.schema)
    writer = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, batch_id: store.upsert(batch, batch_id, query_id(spark, checkpoint))))
    return (writer.trigger(availableNow=True) if available_now else writer).start(), store


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Last emitted row per key of an update-mode result."""
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_l")).select(*keys, "_l.*")


def branch_sinks(df: DataFrame, predicates: list, sinks: list, checkpoint: str):
    """Split a stream reading its input once: `sinks[i](batch, batch_id)` gets the records of branch i."""
    from tideway.operators.stream import Stream

    def route(batch: DataFrame, batch_id: int):
        tagged = Stream(batch).tag_branch(predicates).persist()
        for i, sink in enumerate(sinks):
            sink(tagged.filter(F.col("branch") == i).drop("branch"), batch_id)
        tagged.unpersist()

    return (df.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def with_fresh_table(stream: DataFrame, read_table, join, sink, checkpoint: str):
    """Join each micro-batch with a table read anew: `sink(join(batch, read_table()), batch_id)`."""
    return (stream.writeStream.foreachBatch(lambda batch, i: sink(join(batch, read_table()), i))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def join_global_store(stream: DataFrame, store: Store, join, sink, checkpoint: str, available_now: bool = True):
    """Start a query that joins each micro-batch with the store as it is then: `sink(join(batch, snapshot), batch_id)`.

    The version that a micro-batch saw is noted beside its checkpoint, so that a replay sees the same one although the store has gone on.
    """
    spark = stream.sparkSession
    notes = f"{checkpoint.rstrip('/')}-versions"

    def seen(batch_id: int) -> int:
        try:
            return spark.read.schema("version long").parquet(f"{notes}/batch={batch_id}").first()[0]
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            spark.createDataFrame([(store.version(),)], "version long").coalesce(1).write.parquet(f"{notes}/batch={batch_id}")
            return seen(batch_id)

    writer = (stream.writeStream.foreachBatch(lambda batch, i: sink(join(batch, store.snapshot(seen(i))), i))
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
