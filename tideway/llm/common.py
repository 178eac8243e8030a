"""What several operators share: written tables, connected components and linking within buckets."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable
from contextvars import ContextVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideway.session import fresh_path

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)  # tables written for the frame being built

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def released(run: Callable) -> Callable:
    """`run` over batches, after which a worker that waits for its next task gives back the memory it doesn't use."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
                libc.malloc_trim(0)

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """The frame as a table in the shared folder: computed once, readable after any executor is lost. With `keep` it outlives the frame it is written for."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    # what the write shuffles is removed once it is there, not when the driver's next garbage collection finds it; nothing else reads it
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    if not keep and (made := _made.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def alone(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The frame that `build` gives, as a table. The tables that were written for it are removed once it is there, as nothing reads them any more."""
    before = _made.set(paths := [])
    try:
        df = build()
    finally:
        _made.reset(before)
    out = written(df, label)
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return out


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """The frame as a table in the shared folder whose files are dealt by `key`: later joins and groupings on it need no exchange."""
    spark = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"dealt_{uuid.uuid4().hex}"
    (df.repartition(n, key).write.option("compression", "zstd").option("path", fresh_path(spark, "dealt"))
     .bucketBy(n, key).saveAsTable(name))
    return spark.table(name)


def forest(near: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the links of a symmetric matrix."""
    label = np.arange(len(near))
    while True:
        lower = np.minimum(label, np.where(near, label, len(near)).min(axis=1, initial=len(near)))
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def sorted_groups(batches, key: list[str]):
    """Whole groups from batches sorted by key."""
    held = None
    for batch in batches:
        batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(batch):
            continue
        starts = np.flatnonzero((batch[key] != batch[key].shift()).any(axis=1).to_numpy())
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield batch.iloc[a:b]
        held = batch.iloc[starts[-1]:]
    if held is not None and len(held):
        yield held


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                        .alias("e")).select("e.a", "e.b")


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Rows (id, component) for every id in the links (a, b); component is the smallest id that can be reached.

    Alternates "larger neighbours point to the smallest neighbour" and "smaller neighbours point to the smallest one"
    until nothing changes. Each step is a grouped minimum (combined before the shuffle) and a join; no neighbour list is gathered.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _digest(edges)
    while before[0]:
        around = _both_ways(edges)
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        edges = written(small, "edges")
        now = _digest(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct())


def link(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], settle: Callable[[DataFrame], DataFrame] | None = None,
         facts: DataFrame | None = None, alike: Callable[[str, str], Column] | None = None) -> DataFrame:
    """Connected classes (id, component) of ids that share a bucket and pass `verify`. `buckets` has (key, id).

    First the ids of each bucket are checked against its smallest and its largest id, so that a bucket of m near copies costs 2m checks
    and not m². Ids still outside the class of the smallest one are then checked against every id of the bucket in another
    class, so no link between classes is lost. `verify` takes distinct pairs (a, b) and returns those that hold. With `settle`, buckets
    with ids outside are not turned into pairs but handed over as rows (key, id, component, head), head being the class of the
    smallest id, for links (a, b) of ids or components that join all that is linked in them. With `facts` (id, …), pairs of ids outside are made only
if `alike("x", "y")` holds for their facts, named x_… and y_…; it must hold for all that `verify` returns.
    """
    shared = buckets.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))
    shared = shared.where("first < last").select("key", "first", "last")
    rows = written(buckets.join(shared, "key"), "buckets")

    def ordered(x: str, y: str) -> list:
        return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]

    led = rows.select(F.explode(F.array(F.struct(*ordered("id", "first")), F.struct(*ordered("id", "last")))).alias("p"))
    tried = written(led.select("p.a", "p.b").where("a <> b").distinct(), "tried")
    links = written(verify(tried).select("a", "b"), "links")
    classes = components(links)
    classed = rows.join(classes, "id", "left").withColumn("component", F.coalesce("component", "id"))
    heads = classed.where("id = first").select("key", F.col("component").alias("head")).distinct()
    classed = written(classed.select("key", "id", "component").join(heads, "key"), "classed")
    outside = classed.where("component <> head")
    inside = classed.join(outside.select("key").distinct(), "key", "left_semi")
    if settle is not None:
        more = written(settle(inside.select("key", "id", "component", "head")).select("a", "b"), "links")
    else:
        sides = {"x": outside.select("key", F.col("id").alias("x"), F.col("component").alias("mine")),
                 "y": inside.select("key", F.col("id").alias("y"), F.col("component").alias("other"), "head")}
        if facts is not None:
            sides = {x: rows.join(facts.select(*[F.col(c).alias(x if c == "id" else f"{x}_{c}") for c in facts.columns]), x) for x, rows in sides.items()}
        rest = (sides["x"].join(sides["y"], "key").where("mine <> other and (other = head or x < y)")
                .where(F.lit(True) if alike is None else alike("x", "y")).select(*ordered("x", "y")).distinct().join(tried, ["a", "b"], "left_anti"))
        more = written(verify(written(rest, "rest")).select("a", "b"), "links")
    if more.isEmpty():
        return classes
    # the classes so far are a forest of all earlier links
    return components(classes.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
