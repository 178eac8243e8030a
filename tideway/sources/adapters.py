"""The test tables as keyed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideway.operators.stream import Stream
from tideway.operators.table import Table
from tideway.record import as_records
from tideway.session import fresh_path


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_records(df: DataFrame) -> DataFrame:
    return as_records(
        df,
        topic=F.col("event_type"), partition=F.col("user_id") % 4, offset=F.col("event_id"),
        timestamp=F.col("ts"), key=F.col("user_id"), value=F.struct("event_type", "value", "props"),
    )


def events(spark: SparkSession, sf_dir: str) -> Stream:
    """`events` keyed by user; topic = event type, offset = event id, four partitions."""
    return Stream(event_records(raw(spark, sf_dir, "events")))


def order_records(df: DataFrame) -> DataFrame:
    return as_records(
        df, topic="orders", offset=F.col("o_orderkey"), timestamp=F.col("o_orderdate"), key=F.col("o_custkey"),
        value=F.struct("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
    )


def orders(spark: SparkSession, sf_dir: str) -> Table:
    """`orders` as a table keyed by customer; updates arrive by order date, then order key."""
    return Table(order_records(raw(spark, sf_dir, "orders")), order=["timestamp", "offset"])


def customers(spark: SparkSession, sf_dir: str) -> Stream:
    df = raw(spark, sf_dir, "customer")
    return Stream(as_records(
        df, topic="customer", offset=F.col("c_custkey"), key=F.col("c_custkey"),
        value=F.struct("c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    ))


def customer_table(spark: SparkSession, sf_dir: str) -> Table:
    return Table(customers(spark, sf_dir).df, order=["offset"])


def nations(spark: SparkSession, sf_dir: str) -> Table:
    df = raw(spark, sf_dir, "nation")
    return Table(as_records(
        df, topic="nation", offset=F.col("n_nationkey").cast("bigint"), key=F.col("n_nationkey"),
        value=F.struct("n_name", "n_regionkey"),
    ), order=["offset"])


def documents(spark: SparkSession, sf_dir: str) -> Stream:
    df = raw(spark, sf_dir, "documents")
    return Stream(as_records(
        df, topic="documents", offset=F.col("doc_id"), key=F.col("doc_id"), value=F.struct("text", "lang", "source"),
    ))


def cents(c: Column) -> Column:
    """Money as whole cents, so that sums do not depend on the order of addition."""
    return F.round(c * 100).cast("bigint")


CLOSING_KEY = -1  # key of the records that only move event time on


def streamed(spark: SparkSession, sf_dir: str, name: str, closing: DataFrame | None = None) -> DataFrame:
    """A test table as an endless frame, followed by `closing` rows (same columns) if given."""
    def read(path: str, schema) -> DataFrame:
        return spark.readStream.schema(schema).parquet(path)

    table = raw(spark, sf_dir, name)
    # as a pattern, since a file stream takes a table that is one file only by pattern
    df = read(f"{sf_dir.rstrip('/')}/{name}.parque[t]", table.schema)
    if closing is None:
        return df
    path = fresh_path(spark, f"closing-{name}")
    closing.select(*[F.col(f.name).cast(f.dataType) for f in table.schema]).write.parquet(path)
    return df.unionByName(read(path, table.schema))


def events_stream(spark: SparkSession, sf_dir: str, closing: bool = True) -> Stream:
    """`events` as a stream. Windows, sessions and unmatched records are only emitted once event time has passed them,
    so one late record per event type, keyed `CLOSING_KEY`, follows the data; results for that key are not part of it."""
    last = raw(spark, sf_dir, "events").groupBy("event_type").agg(F.max("ts").alias("ts")).select(
        (F.monotonically_increasing_id() + 10**15).alias("event_id"),
        (F.col("ts") + F.expr("INTERVAL 400 DAYS")).alias("ts"),
        F.lit(CLOSING_KEY).alias("user_id"), "event_type", F.lit(0.0).alias("value"), F.lit("{}").alias("props"),
    )
    return Stream(event_records(streamed(spark, sf_dir, "events", last if closing else None)))


FILE_ROWS = 500_000  # a file of a micro-batch has up to twice as many


def events_in_batches(spark: SparkSession, sf_dir: str, order: list[Column], batches: int = 3) -> Stream:
    """`events` as a stream that arrives in several micro-batches, in the given order, and then a late record that moves event time past all of them."""
    df = raw(spark, sf_dir, "events")
    path = fresh_path(spark, "batches")
    files = max(1, -(-df.count() // batches // FILE_ROWS))
    # a micro-batch per step, of as many files each; files are taken by their time, so steps are written one after the other
    cut = df.withColumn("_part", F.ntile(batches).over(Window.partitionBy(F.col("user_id") % 64).orderBy(*order)))
    cut.write.partitionBy("_part").parquet(f"{path}-cut")
    parts = spark.read.schema(cut.schema).parquet(f"{path}-cut")
    for i in range(1, batches + 1):
        part = parts.filter(F.col("_part") == i).drop("_part")
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(path)
    last = df.agg(F.max("ts").alias("ts")).select(
        F.lit(10**15).alias("event_id"), (F.col("ts") + F.expr("INTERVAL 400 DAYS")).alias("ts"), F.lit(CLOSING_KEY).alias("user_id"),
        F.lit("click").alias("event_type"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"))
    last.select(*[F.col(f.name).cast(f.dataType) for f in df.schema]).coalesce(1).write.mode("append").parquet(path)
    return Stream(event_records(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)))


def orders_stream(spark: SparkSession, sf_dir: str) -> Table:
    df = streamed(spark, sf_dir, "orders")
    return Table(order_records(df), order=["timestamp", "offset"])
