"""Where a hot key is cut so that no task has to hold all of its records.

A keyed operator that needs order (previous value, running total, session, as-of lookup, numbering)
would put every record of a key in one task. That is right for ordinary keys and fatal for a key
that holds a third of the input. `measure` looks at a sample of (key, order) and returns, for the hot
keys only, cut points in the order; records between two cuts form a *chunk*. Chunks are shuffled
and sorted independently, and `scans` carries a small summary from one chunk to the next.

The sample decides only where the cuts are, never which rows take part: a key the sample misses is
simply not cut. With no hot key there is no layout, and operators use the plain one-shuffle plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideway.session import chunk_rows as session_chunk_rows

SAMPLES_TO_BE_HOT = 64      # sampled rows at which a key counts as hot
SAMPLES_PER_CHUNK = 32      # sampled rows that place one cut
MAX_CHUNKS = 4096           # cuts per hot key; above this, chunks grow instead


@dataclass(frozen=True)
class Layout:
    """Cut points per hot key. `frame` has the key columns and `_cuts`, a sorted array of order structs.

    `order` may be the first columns of the order a scan uses: chunks then still follow that order.

    Its size is bounded by rows / chunk_rows entries over all keys together, so it can be broadcast
    whatever the input size.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    frame: DataFrame
    depth: int  # the longest `_cuts` is shorter than 2 ** depth

    def assign(self, df: DataFrame) -> DataFrame:
        """Add `_chunk` (0 for keys that were not cut) and `_hot`."""
        columns = [df[c] for c in df.columns]
        joined = df.join(F.broadcast(self.frame), list(self.keys), "left").select(
            *columns, "_cuts",
            F.when(F.col("_cuts").isNotNull(), F.struct(*[df[c] for c in self.order])).alias("_here"),
            F.lit(0).alias("_chunk"),
        )
        # binary search for the number of cuts at or before this record, one step per projection: stays in generated code
        for step in reversed(range(self.depth)):
            probe = F.col("_chunk") + (1 << step)
            joined = joined.withColumn(
                "_chunk", F.when(F.get("_cuts", probe - 1) <= F.col("_here"), probe).otherwise(F.col("_chunk")))
        return joined.select(*df.columns, "_chunk", F.col("_cuts").isNotNull().alias("_hot"))


def measure(
    df: DataFrame, keys: list[str], order: list[str], chunk_rows: int | None = None
) -> Layout | None:
    """Find hot keys and their cut points; None when no key is hot.

    Reads only the key columns once, on a sample that is aggregated before it is shuffled; a second
    look at key and order columns happens only for keys found hot. What reaches the driver is at
    most one short row per hot key (rows / chunk_rows of them).
    """
    spark = df.sparkSession
    chunk_rows = chunk_rows or session_chunk_rows(spark)
    fraction = min(1.0, SAMPLES_TO_BE_HOT / chunk_rows)
    threshold = SAMPLES_TO_BE_HOT if fraction < 1.0 else chunk_rows + 1
    slim = df.select(*keys, *[c for c in order if c not in keys])
    for name in keys:
        slim = slim.filter(F.col(name).isNotNull())
    sampled = slim.sample(fraction, seed=7) if fraction < 1.0 else slim
    counts = sampled.groupBy(*keys).count().filter(F.col("count") >= threshold)
    hot = counts.collect()
    if not hot:
        return None

    key_fields = [slim.schema[k] for k in keys]
    plan_schema = T.StructType(
        key_fields + [T.StructField("_rate", T.DoubleType()), T.StructField("_n", T.IntegerType())]
    )
    plan = []
    for row in hot:
        rows = row["count"] / fraction
        chunks = max(2, min(MAX_CHUNKS, int(-(-rows // chunk_rows))))
        plan.append((*[row[k] for k in keys], min(1.0, SAMPLES_PER_CHUNK * chunks / rows), chunks))
    planned = spark.createDataFrame(plan, plan_schema)
    at = F.struct(*[F.col(c) for c in order])
    densest = max(row[len(keys)] for row in plan)
    candidates = slim.sample(densest, seed=5) if densest < 1.0 else slim
    cut = (
        candidates.join(F.broadcast(planned), keys)
        .filter(F.rand(11) * densest < F.col("_rate"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(at)).alias("_s"), F.first("_n").alias("_n"))
        .select(
            *keys,
            F.array_distinct(
                F.transform(
                    F.sequence(F.lit(1), F.col("_n") - 1),
                    lambda i: F.get(F.col("_s"), F.floor(i * F.size("_s") / F.col("_n")).cast("int")),
                )
            ).alias("_cuts"),
        )
        .filter(F.size("_cuts") > 0)
    )
    # collected so that every use sees the same cuts, also after a task is run again elsewhere
    rows = cut.collect()
    if not rows:
        return None
    depth = max(len(r["_cuts"]) for r in rows).bit_length()
    return Layout(tuple(keys), tuple(order), spark.createDataFrame(rows, cut.schema), depth)


def in_chunk_order(order: list[str], reverse: bool = False) -> list[Column]:
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
